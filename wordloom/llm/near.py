"""Near-dedup: consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import arrow_rows, attach, components, row_key, whole, written
from wordloom.llm.rtree import Rule, forest, grouped, groups_of, paged, runs, stacked, texts_of, unpacked
from wordloom.llm.shingles import K, mixed, rolled, words

SIMILAR = 0.8
# A pair at 0.8 shares a band with 1 - (1 - 0.8**3)**10, over 0.999.
BANDS = 10
ROWS = 3
# Document frequencies are counted by hashed word; the table has this fixed size.
DF_SLOTS = 1 << 20

_ODD = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_DRAWS = 1 << 16
_CELLS = 1 << 18
_UNIT = 0.125
# Texts that go to Python at a time.
BATCH = 1000
# What one R-tree holds at most.
PAGE = 1 << 12
PAGE_SHINGLES = 1 << 20


def _drawn() -> tuple[np.ndarray, ...]:
    """Tables of r and c, gamma (2, 1) each, and beta, uniform, as the sampling asks for."""
    rng = np.random.Generator(np.random.PCG64(20210))
    r, c = rng.gamma(2.0, 1.0, _DRAWS), rng.gamma(2.0, 1.0, _DRAWS)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(c).astype(np.float32), rng.random(_DRAWS).astype(np.float32)


_R, _INVERSE, _LOG_C, _BETA = _drawn()


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that have each hashed word, over all documents; then, in the last place, all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DF_SLOTS + 1, np.int64), 0
        for b in batches:
            for text in b.text:
                total[np.unique(words(text) & np.uint64(DF_SLOTS - 1)).astype(np.int64)] += 1
            n += len(b)
        total[-1] = n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": total[at]})

    summed = docs.select(whole("text").alias("text")).mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()  # DF_SLOTS + 1 rows at most
    out = np.zeros(DF_SLOTS + 1, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def idf(frequencies: np.ndarray) -> np.ndarray:
    n = frequencies[-1]
    return (1 + np.log((n + 1) / (frequencies[:-1] + 1))).astype(np.float32)


def weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights: occurrences times the mean idf of the words.

    The idf of words, not of shingles: copies would make their own shingles
    frequent and so hide themselves, and nearly all other shingles are unique.
    """
    w = words(text)
    h = rolled(w)
    if not len(h):
        return h, np.zeros(0, np.float32)
    rare = np.concatenate([[0.0], np.cumsum(idf[(w & np.uint64(DF_SLOTS - 1)).astype(np.int64)], dtype=np.float64)])
    k = min(K, len(w))
    distinct, first, n = np.unique(h, return_index=True, return_counts=True)
    return distinct, (n * (rare[first + k] - rare[first]) / k).astype(np.float32)


def bands(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Band keys of weighted shingles; none without shingles."""
    if not len(h):
        return np.zeros(0, np.int64)
    out, steps = np.empty(BANDS * ROWS, np.uint64), np.empty(BANDS * ROWS, np.int64)
    log_w = np.log(w)
    # All draws at once for most texts, one at a time for the longest, so that memory stays bounded.
    step = max(1, _CELLS // len(h))
    for i in range(0, len(out), step):
        at = ((h[None, :] * _ODD[i : i + step, None]) >> np.uint64(48)).astype(np.int32)
        r, beta = _R[at], _BETA[at]
        t = np.floor(log_w * _INVERSE[at] + beta)
        best = np.argmin(_LOG_C[at] - r * (t - beta + 1), axis=1)
        out[i : i + step], steps[i : i + step] = h[best], t[np.arange(len(best)), best]
    out = mixed(out + steps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + out[:, j])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: sum of smaller over sum of larger weights."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    i = np.flatnonzero(b[0][at] == a[0])
    both = float(np.minimum(a[1][i], b[1][at[i]]).sum(dtype=np.float64))
    return both / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - both)


def _units(values: np.ndarray) -> np.ndarray:
    """Weights in whole units, rounded up, so that sums of minima stay bounds."""
    out = np.ceil(values * (1.000001 / _UNIT))
    return out.astype(np.min_scalar_type(int(out.max(initial=0))))


def group_weights(h: np.ndarray, w: np.ndarray, g: int) -> np.ndarray:
    """The weights of the shingles in each of g groups, in units."""
    return _units(np.bincount((h & np.uint64(g - 1)).astype(np.int64), weights=w, minlength=g))


def link_rule(similar: float) -> Rule:
    """On totals in units, rounded down; a little less than a link asks for, as the bounds are rounded too."""
    return Rule(lambda n: np.floor(similar * n * 0.99999) - 1, lambda a, b: np.floor(similar / (1 + similar) * (a + b) * 0.99999) - 1)


_KEYS = ["key", "i", "j"]
_FAMILY = ["family", "i", "j"]


def _bounded(rule: Rule):
    """Within the texts of a band key: pairs whose bounds a link could reach, as many as connect the texts that such pairs connect."""

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, _KEYS):
            cuts = runs(frame, _KEYS)
            node, total = frame["node"].to_numpy(np.int64), frame["total"].to_numpy(np.int64)
            vectors = [unpacked(n, data) for n, data in zip(frame["n"], frame["weights"])]
            first, second = [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    links = forest(stacked(vectors[a:b]), total[a:b], lambda i, others: np.ones(len(others), bool), rule)
                    first += [node[a + i] for i, _ in links]
                    second += [node[a + j] for _, j in links]
            yield pd.DataFrame({"a": np.array(first, np.int64), "b": np.array(second, np.int64)})

    return bounded


def _verified(rule: Rule, similar: float, rare):
    """Within a family: links that connect all that links connect, by the weighted similarity of the texts."""

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, _FAMILY):
            cuts = runs(frame, _FAMILY)
            node = frame["node"].to_numpy(np.int64)
            first, second = [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a < 2:
                    continue
                own = [weighted(t, rare.value) for t in frame.text[a:b]]
                totals = np.array([_total(w) for _, w in own], np.int64)
                g = groups_of(min(len(h) for h, _ in own))
                points = np.stack([group_weights(h, w, g) for h, w in own])
                test = lambda i, others, own=own: np.array([similarity(own[i], own[j]) >= similar for j in others], bool)
                links = forest(points, totals, test, rule)
                first += [node[a + i] for i, _ in links]
                second += [node[a + j] for _, j in links]
            yield pd.DataFrame({"a": np.array(first, np.int64), "b": np.array(second, np.int64)})

    return verified


def _total(w: np.ndarray) -> int:
    return int(float(w.sum(dtype=np.float64)) / _UNIT)


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """A row for each row of docs: ``_row`` (its row key), doc_id, class_id, class_size, kept.

    A class are the documents that links join, a link being a weighted Jaccard
    similarity of ``similar`` or more; equal texts are one node and always
    share a class.  class_id is the smallest doc_id of the class (null if none
    has one), and one row of that id is kept.  Null texts are empty; texts
    without words have only equal texts in their class.

    Candidates share a band key: BANDS rows a text.  The texts of a key are
    points of weights by group of shingles, in units rounded up, and sums of
    coordinate minima in an R-tree bound their similarity.  A forest of the
    pairs that the bounds let through gives families; the texts of a family
    come together once, and their links are verified, without testing what is
    connected already.  Keys and families beyond a page (PAGE texts or
    PAGE_SHINGLES shingles) are cut into pages, a task taking two.  Nothing is
    capped and no pairs of a group are written, so the rows made grow with the
    texts.  What can be missed is a link whose ends share no band and are not
    brought into one family by others: fewer than 1 in 1,000 at ``similar`` 0.8.
    """
    with arrow_rows(docs.sparkSession, BATCH):
        return _classes(docs, similar)


def _classes(docs: DataFrame, similar: float) -> DataFrame:
    spark = docs.sparkSession
    rare = spark.sparkContext.broadcast(idf(document_frequencies(docs)))  # DF_SLOTS floats

    @F.pandas_udf("keys array<long>, n int, total long, weights binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                h, w = weighted(text, rare.value)
                out.append((bands(h, w), len(h), _total(w), group_weights(h, w, groups_of(len(h))).tobytes()))
            yield pd.DataFrame(out, columns=["keys", "n", "total", "weights"])

    text = whole("text")
    t1, t2 = F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(11), text, F.octet_length(text)).alias("t2")
    rows = written(
        docs.select(
            row_key(docs).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("seq"),
            t1, t2, sketch(text).alias("sketch"),
        )
    )
    # Equal texts are one node, the first of their rows.
    nodes = written(rows.groupBy("t1", "t2").agg(F.min("seq").alias("node")))
    firsts = rows.join(nodes.select(F.col("node").alias("seq")), "seq", "left_semi").select(F.col("seq").alias("node"), "t1", "t2", "sketch.*")
    entries = firsts.select("node", "n", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("shingles")).where("m > 1")
    pages = F.greatest(F.ceil(F.col("m") / PAGE), F.ceil(F.col("shingles") / PAGE_SHINGLES))
    dealt = entries.join(shared, "key").join(firsts.select("node", "total", "weights"), "node")
    dealt = paged(dealt, ["key"], pages).select(*_KEYS, "node", "n", "total", "weights")
    rule = link_rule(similar)
    near = written(dealt.mapInPandas(_bounded(rule), "a long, b long").distinct())

    families = components(near).select("node", F.col("comp").alias("family"))
    needed = written(families.join(firsts.select("node", "n", "t1", "t2"), "node"))
    sized = needed.groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    members = needed.select("family", "node").join(texts_of(docs.select(text.alias("text")), needed.select("node", "t1", "t2")), "node").join(sized, "family")
    links = written(paged(members, ["family"], pages).select(*_FAMILY, "node", "text").mapInPandas(_verified(rule, similar, rare), "a long, b long"))
    comps = components(links)
    found = nodes.join(comps, "node", "left").select("t1", "t2", F.coalesce("comp", "node").alias("comp"))
    placed = written(rows.join(found, ["t1", "t2"]).select("_row", "doc_id", "seq", "comp"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "seq")
    each = placed.groupBy("comp").agg(F.min(first).alias("first"), F.count("*").alias("class_size"))
    return placed.join(each, "comp").select(
        "_row", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("seq") == F.col("first.seq")).alias("kept")
    )


def deduplicated(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """docs with one row of each class, all columns as they are."""
    return attach(docs, classes(docs, similar).where("kept").select("_row"))
