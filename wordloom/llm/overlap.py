"""N-gram Jaccard join: count vectors in R-trees bound the overlaps, survivors are verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import components, whole, written
from wordloom.llm.rtree import SMALL, Rule, digests, folded, forest, grouped, groups_of, paged, runs, stacked, texts_of, unpacked
from wordloom.llm.shingles import rolled
from wordloom.sources.files import spread

K = 4
# Two sets link at 100 * intersection >= SIMILAR * union.
SIMILAR = 85
# Frequencies of shingles are counted in this many slots; they only order shingles, rare ones first.
SLOTS = 1 << 20
# Bytes of count vectors that one tree holds; more points are dealt to pages, and a task takes two pages.
PAGE_BYTES = 1 << 20
_REMEMBERED = 1 << 17


class _Words(dict):
    """Hashes by word, remembered up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct K-word shingles; words are runs without ASCII white space, A-Z lower-cased."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    return np.unique(rolled(np.fromiter(map(_words.__getitem__, found), np.uint64, len(found)), K))


def _least(n):
    """Shingles that a set of n shares with any set it links with."""
    return (SIMILAR * n + 99) // 100


def least_overlap(a, b):
    return (SIMILAR * (a + b) + 99 + SIMILAR) // (100 + SIMILAR)


def count_vector(h: np.ndarray, g: int) -> np.ndarray:
    counts = np.bincount((h & np.uint64(g - 1)).astype(np.int64), minlength=g)
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


JACCARD = Rule(_least, least_overlap)

_TASK = ["token", "i", "j"]


def _bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Within the points of a token: pairs that the bounds let through, as many as connect the points that such pairs connect."""
    for frame in grouped(batches, _TASK):
        cuts = runs(frame, _TASK)
        node, n, pos = (frame[c].to_numpy(np.int64) for c in ("node", "n", "pos"))
        vectors = [unpacked(size, data) for size, data in zip(n, frame["counts"])]
        first, second = [], []

        def passes(i: int, others: np.ndarray, at: int) -> np.ndarray:
            """The shingles from the token on, in the order of all shingles, bound the overlap as well."""
            a, b = i + at, others + at
            return np.minimum(n[a] - pos[a], n[b] - pos[b]) >= least_overlap(n[a], n[b])

        pairs = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a <= SMALL:
                pairs += [(x, y) for x in range(a, b) for y in range(x + 1, b)]
                continue
            links = forest(stacked(vectors[a:b]), n[a:b], lambda i, others, at=a: passes(i, others, at), JACCARD)
            first += [node[a + i] for i, _ in links]
            second += [node[a + j] for _, j in links]
        if pairs:
            x, y = np.array(pairs).T
            least = least_overlap(n[x], n[y])
            fits = (np.minimum(n[x], n[y]) >= least) & (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= least)
            for x, y, need in zip(x[fits], y[fits], least[fits]):
                g = min(len(vectors[x]), len(vectors[y]))
                if int(np.minimum(folded(vectors[x], g), folded(vectors[y], g)).sum(dtype=np.int64)) >= need:
                    first.append(node[x])
                    second.append(node[y])
        yield pd.DataFrame({"a": np.array(first, np.int64), "b": np.array(second, np.int64)})


_FAMILY = ["family", "i", "j"]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Within a family: links that connect all that links connect, verified on the sets."""
    for frame in grouped(batches, _FAMILY):
        cuts = runs(frame, _FAMILY)
        node = frame["node"].to_numpy(np.int64)
        first, second = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            sets = [shingle_set(t) for t in frame.text[a:b]]
            sizes = np.array([len(s) for s in sets], np.int64)

            def links_with(i: int, others: np.ndarray) -> np.ndarray:
                lengths = sizes[others]
                data = np.concatenate([sets[j] for j in others])
                at = np.minimum(np.searchsorted(sets[i], data), len(sets[i]) - 1)
                shared = np.add.reduceat(sets[i][at] == data, np.cumsum(lengths) - lengths, dtype=np.int64)
                return shared >= least_overlap(lengths, sizes[i])

            g = groups_of(int(sizes.min()))
            links = forest(np.stack([count_vector(s, g) for s in sets]), sizes, links_with, JACCARD)
            first += [node[a + i] for i, _ in links]
            second += [node[a + j] for _, j in links]
        yield pd.DataFrame({"a": np.array(first, np.int64), "b": np.array(second, np.int64)})


def _slot_counts(docs: DataFrame) -> np.ndarray:
    """Over all documents, how many distinct shingles fall in each slot."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.text:
                np.add.at(total, (shingle_set(text) & np.uint64(SLOTS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": total[at]})

    rows = docs.select("text").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # SLOTS rows at most
    out = np.zeros(SLOTS, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: its distinct K-word shingles and the smallest doc_id that links reach.

    Null and empty texts and texts of white space have no shingles and link
    with nothing; a text of fewer than K words is one shingle.  Equal sets are
    one node, so copies are never paired.  A null doc_id counts as larger than
    any: it is a component_id only where no other is reached.  Other columns are left out.

    Sets that link share one of their rarest shingles, so each such shingle
    has an R-tree of its own: two unrelated sets of a size have count vectors
    too alike for a tree over all documents to tell them apart.  Pairs that the
    tree's bounds let through join nodes into families, of which a forest is enough;
    the members' texts then come once to their family, whose R-tree yields the
    pairs to verify.  Trees over PAGE_BYTES are cut into pages, a task taking
    two, so the members of a hot shingle or family are spread.  Nothing is capped.
    """
    spark = docs.sparkSession
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")), "doc_id")
    frequent = spark.sparkContext.broadcast(_slot_counts(docs))

    @F.pandas_udf("n int, s1 long, s2 long, prefix array<long>, counts binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            h = shingle_set(text)
            n = len(h)
            order = np.lexsort((h, frequent.value[(h & np.uint64(SLOTS - 1)).astype(np.int64)]))
            prefix = h[order[: n - _least(n) + 1]] if n else h
            digest = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64)
            out.append((n, digest[0], digest[1], prefix.view(np.int64), count_vector(h, groups_of(n)).tobytes()))
        return pd.DataFrame(out, columns=["n", "s1", "s2", "prefix", "counts"])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("node"), *digests(), sketch("text").alias("s"))
    rows = written(rows.select("doc_id", "node", "t1", "t2", "s.*"))
    sets = written(rows.where("n > 0").groupBy("s1", "s2").agg(F.min("node").alias("node"), F.min("doc_id").alias("least_id")))
    nodes = rows.join(sets.select("node"), "node", "left_semi")

    # Of two sets that link, the smaller has the shared one among its rarest n - least_overlap(n, n) + 1.
    short = F.col("n") - F.floor((2 * SIMILAR * F.col("n") + 99 + SIMILAR) / (100 + SIMILAR)) + 1
    entries = written(nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token")))
    early = F.count_if(F.col("pos") < short)
    size = F.expr("128 * pow(8, greatest(0, ceil(log(8, n / 1024))))").cast("long")
    busy = entries.groupBy("token").agg(F.count("*").alias("m"), early.alias("early"), F.sum(size).alias("bytes")).where("m > 1 and early > 0")
    shared = entries.join(busy.select("token", "bytes"), "token").join(nodes.select("node", "counts"), "node")
    dealt = paged(shared, ["token"], F.greatest(F.lit(1), F.ceil(F.col("bytes") / PAGE_BYTES)))
    bounded = written(dealt.select(*_TASK, "node", "n", "pos", "counts").mapInPandas(_bounded, "a long, b long").distinct())

    families = components(bounded).select("node", F.col("comp").alias("family"))
    needed = written(families.join(rows.select("node", "n", "t1", "t2"), "node"))
    sized = needed.groupBy("family").agg(F.ceil(F.sum(size) / PAGE_BYTES).alias("pages"))
    members = needed.join(texts_of(docs, needed.select("node", "t1", "t2")), "node").select("family", "node", "text").join(sized, "family")
    links = written(paged(members, ["family"], F.greatest(F.lit(1), F.col("pages"))).select(*_FAMILY, "node", "text").mapInPandas(_verified, "a long, b long"))

    found = sets.join(components(links), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = found.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    told = found.join(least, "comp").select("s1", "s2", "component_id")
    named = rows.select("doc_id", "n", "s1", "s2").join(told.withColumn("_known", F.lit(True)), ["s1", "s2"], "left")
    return named.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
