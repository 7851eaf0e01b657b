"""Ranked lexical search: bundles of accumulators pass through the owners of the terms, stage by stage."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import whole, written
from wordloom.sources.files import spread

RESULTS = 10
# Owners that the terms are dealt to; a bundle visits them in turn.
STAGES = 4
# Documents of a block, and items that visit a block together: they bound what one task holds.
BLOCK = 2048
ITEMS = 512

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")  # the same in lower-cased UTF-8
_SLOTS = 1 << 22
_SEED = 42
_REMEMBERED = 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term``: the distinct terms of each distinct row ``item_id, text``."""
    distinct = written(items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()))
    terms = F.array_distinct(F.regexp_extract_all(F.translate(whole("text"), _UPPER, _LOWER), F.lit(TERM), 0))
    return written(distinct.select("item", "item_id", F.explode(terms).alias("term")))


class _Asked(dict):
    """Whether an item may have a term, by a bit of its hash; remembered by term up to a number of terms."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    def __missing__(self, term: bytes) -> bool:
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[term] = bool(self.slots[xxhash.xxh64_intdigest(term, _SEED) % _SLOTS])
        return found


def _asked_slots(terms: DataFrame) -> np.ndarray:
    """One flag for each of _SLOTS hash values, however many terms there are."""
    # As unsigned numbers, which the executors' hash gives.
    slot = F.col("h").bitwiseAND(F.lit(_SLOTS - 1)).cast("int").alias("slot")
    rows = terms.select(F.xxhash64("term").alias("h")).select(slot).distinct().toArrow()  # _SLOTS rows at most
    out = np.zeros(_SLOTS, bool)
    out[rows["slot"].to_numpy()] = True
    return out


def _holders(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``seq, doc_id, n, terms, tfs`` of documents with a term; of terms only those that an item may have.

    ``seq`` ascends with doc_id (nulls last), so it decides ties.
    """
    asked = docs.sparkSession.sparkContext.broadcast(_asked_slots(terms))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Asked(asked.value)
        for batch in batches:
            ids, sizes, names, tfs = [], [], [], []
            for i, text in zip(batch.id, batch.text):
                found = _TERM_BYTES.findall(text.encode("utf-8", "replace").lower())
                if found:
                    tf = [(t, n) for t, n in Counter(found).items() if known[t]]
                    ids.append(i)
                    sizes.append(len(found))
                    names.append([t.decode("utf-8", "replace") for t, _ in tf])
                    tfs.append([n for _, n in tf])
            if ids:
                yield pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "n": sizes, "terms": names, "tfs": tfs})

    texts = spread(docs.select(F.col("doc_id").cast("long").alias("id"), whole("text").alias("text")), "id")
    # A table first: cutting ranges reads its input twice.
    counted = written(texts.mapInPandas(count, "id long, n long, terms array<string>, tfs array<long>"))
    order = F.asc_nulls_last("id")
    tied = F.monotonically_increasing_id().alias("_tied")
    ordered = counted.select("*", tied).repartitionByRange(order, "_tied").sortWithinPartitions(order, "_tied")
    return written(ordered.select(F.monotonically_increasing_id().alias("seq"), F.col("id").alias("doc_id"), "n", "terms", "tfs"))


def _visit(last: bool, k: int):
    """A bundle takes up the contributions of its terms that this owner has for the block."""

    def visit(bundles: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        postings = postings.sort_values("code", kind="stable")
        codes, doc, add = (postings[c].to_numpy(np.int64) for c in ("code", "seq", "add"))
        out_docs, out_scores = [], []
        for own, docs, scores in zip(bundles.codes, bundles.docs, bundles.scores):
            left, right = np.searchsorted(codes, own, "left"), np.searchsorted(codes, own, "right")
            spans = [(a, b) for a, b in zip(left, right) if a < b]
            docs, scores = np.asarray(docs, np.int64), np.asarray(scores, np.int64)
            if spans:
                each, at = np.unique(np.concatenate([docs, *(doc[a:b] for a, b in spans)]), return_inverse=True)
                total = np.zeros(len(each), np.int64)
                np.add.at(total, at, np.concatenate([scores, *(add[a:b] for a, b in spans)]))
                docs, scores = each, total
            if last:
                best = np.lexsort((docs, -scores))[:k]
                best = best[scores[best] > 0]
                docs, scores = docs[best], scores[best]
            out_docs.append(docs)
            out_scores.append(scores)
        return bundles.assign(docs=pd.Series(out_docs, index=bundles.index, dtype=object), scores=pd.Series(out_scores, index=bundles.index, dtype=object))

    return visit


_BUNDLE = "part long, block long, item long, codes array<long>, docs array<long>, scores array<long>"


def rank(docs: DataFrame, items: DataFrame, k: int = RESULTS, stages: int = STAGES) -> DataFrame:
    """``item, item_id, rank, doc_id, score``: the k best documents of each item, scores above 0 only.

    Terms are runs of ASCII letters and digits and of all characters beyond
    ASCII, A-Z lower-cased.  With N documents that have a term and L terms in
    all of them, a term of df documents weighs ``floor(1000 ln((2N+2)/(2df+1)))``
    and adds ``weight * (10**9 tf div (1000 tf + 8 m))`` to a document of n
    terms, ``m = 10 + 90 n N div L``, all in 64-bit integers.  Equal scores go
    to the smaller doc_id, null ids last.  A repeated item counts once, items
    of one id and other texts apart (``item``); repeated documents count each.
    Null and empty texts have no terms; other columns are left out.

    Documents are dealt to blocks, items to parts, terms to ``stages`` owners.
    A bundle is an item with its term codes and the sparse accumulators of one
    block.  At each stage the bundles of a block meet, by cogroup, the postings
    that this owner has for the block, and go on with their sums; the last
    stage keeps each bundle's k best.  A frequent term is spread over
    all blocks, and a task holds a block's postings and at most ITEMS bundles.
    """
    terms = item_terms(items)
    held = _holders(docs, terms)
    n_docs, n_terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n_parts = -(-terms.agg(F.count_distinct("item")).first()[0] // ITEMS)
    terms = terms.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(max(1, n_parts))))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    known = written(terms.select("term").distinct().join(df, "term").select("term", weight.alias("weight"), F.monotonically_increasing_id().alias("code")))
    owner = F.pmod(F.xxhash64("code"), F.lit(stages)).cast("int")
    coded = terms.join(known, "term")

    block = F.pmod(F.xxhash64("seq"), F.lit(max(1, -(-n_docs // BLOCK)))).alias("block")
    m = F.lit(10) + F.floor(F.expr(f"(90 * n * {n_docs}L) div {max(1, n_terms)}L"))
    each = held.select("seq", block, m.cast("long").alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("seq", "block", "m", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    add = F.expr("weight * ((1000000000L * tf) div (1000L * tf + 8L * m))").alias("add")
    asking = coded.select("term", "weight", "code", "part").distinct()
    postings = written(each.join(asking, "term").select("part", "block", "code", "seq", add, owner.alias("owner")))

    visited = postings.select("part", "block").distinct()
    bundled = coded.groupBy("part", "item").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    nothing = F.array().cast("array<long>")
    bundles = bundled.join(visited, "part").select("part", "block", "item", "codes", nothing.alias("docs"), nothing.alias("scores"))
    for stage in range(stages):
        owned = postings.where(F.col("owner") == stage).select(*(F.col(c).alias(c) for c in ("part", "block", "code", "seq", "add")))  # columns of its own
        bundles = bundles.groupBy("part", "block").cogroup(owned.groupBy("part", "block")).applyInPandas(_visit(stage == stages - 1, k), _BUNDLE)

    found = bundles.select("item", F.explode(F.arrays_zip("docs", "scores")).alias("d")).select("item", F.col("d.docs").alias("seq"), F.col("d.scores").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "seq"))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    ids = terms.select("item", "item_id").distinct()
    return best.join(ids, "item").join(held.select("seq", "doc_id"), "seq").select("item", "item_id", "rank", "doc_id", "score")
