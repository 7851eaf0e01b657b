"""Sharding by sampled splitters into ranges of nearly equal bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import attach, row_key, written

SHARDS = 16
# Rows that one range should have; a range is one window partition of narrow rows.
RANGE_ROWS = 200_000
# Samples drawn for each range, on average.
OVERSAMPLE = 64


def _hex(x: Column) -> Column:
    return F.lpad(F.hex(x), 16, "0")


def _range_of(bounds: list[str]):
    cuts = np.array(bounds, dtype="S32")

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy().astype("S32"), side="right").astype("int32"))

    return find if bounds else (lambda c: F.lit(0))


def _draw(rows: DataFrame, per_byte: Column, seed: int) -> DataFrame:
    """Keys of a size-weighted sample: a row is drawn with a chance in proportion to its size."""
    uniform = F.shiftrightunsigned(F.xxhash64("_key", F.lit(seed)), 11) / F.lit(2.0**53)
    return rows.where(uniform < per_byte * F.col("size"))


def shards(docs: DataFrame, keep: list[str], n: int = SHARDS, range_rows: int = RANGE_ROWS, seed: int = 1) -> DataFrame:
    """Shard and place of each row: ``keep``, size, shard, slot.

    Sizes are the UTF-8 bytes of the text plus 1, a null text having none.  Rows
    are ordered by hashes of text and id.  A size-weighted sample of keys gives
    splitters at its quantiles; ranges that turn out overfull are sampled again
    and subdivided until none is, so equal texts, however many, spread over
    ranges by id.  A row's shard follows from the bytes before it: sums of whole
    ranges plus the running sum within its own, so shards differ by about one
    document.  ``slot`` counts from 0 without gaps in each shard.  Equal texts
    are neighbours in this order and share a shard unless a boundary cuts
    them.  An empty table gives no rows; repeated rows are placed one by one.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    # Rows with one key are equal in text and id; which of them is first makes no difference.
    key = F.concat(_hex(F.xxhash64(text)), _hex(F.xxhash64(F.lit(seed), "doc_id")))
    rows = written(docs.select(*keep, size.alias("size"), key.alias("_key")))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(n, -(-count // range_rows))
    bounds: list[str] = []
    if total:
        drawn = sorted(r[0] for r in _draw(rows, F.lit(OVERSAMPLE * ranges / total), seed).select("_key").collect())
        bounds = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []
    limit, most = 2.5 * total / ranges, 2.5 * range_rows
    while total:
        placed = rows.withColumn("_range", _range_of(bounds)("_key"))
        sums = placed.groupBy("_range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("_key").alias("low"), F.max("_key").alias("high")
        ).collect()  # one row a range
        full = {r["_range"]: r for r in sums if (r["bytes"] > limit or r["rows"] > most) and r["low"] < r["high"]}
        if not full:
            break
        share = F.element_at(F.create_map(*(x for k, r in full.items() for x in (F.lit(k), F.lit(4 * OVERSAMPLE / r["bytes"])))), F.col("_range"))
        seed += 1
        again: dict[int, list[str]] = {k: [] for k in full}
        for r in _draw(placed.where(F.col("_range").isin(list(full))), share, seed).select("_range", "_key").collect():
            again[r["_range"]].append(r["_key"])
        new = set(bounds)
        for k, drawn in again.items():
            drawn.sort()
            parts = max(2, int(full[k]["bytes"] // (limit / 2)), int(full[k]["rows"] // range_rows))
            cuts = {drawn[len(drawn) * i // parts] for i in range(1, parts)} if drawn else set()
            cuts = {c for c in cuts if full[k]["low"] < c}
            new |= cuts or {full[k]["high"]}
        bounds = sorted(new)
    if not total:
        placed, sums = rows.withColumn("_range", F.lit(0)), []
    starts, at = [], [0, 0]
    for r in sorted(sums, key=lambda r: r["_range"]):
        starts.append((r["_range"], at[0], at[1]))
        at = [at[0] + r["bytes"], at[1] + r["rows"]]
    first = F.broadcast(docs.sparkSession.createDataFrame(starts, "_range int, _bytes long, _rows long"))
    w = Window.partitionBy("_range").orderBy("_key")
    run = w.rowsBetween(Window.unboundedPreceding, -1)
    run_bytes = F.col("_bytes") + F.coalesce(F.sum("size").over(run), F.lit(0))
    numbered = placed.join(first, "_range").select(
        *keep, "size", run_bytes.alias("_before"), (F.col("_rows") + F.row_number().over(w) - 1).alias("_at")
    )
    middle = (F.col("_before") + F.col("size") / 2) * n / F.lit(float(max(total, 1)))
    numbered = written(numbered.withColumn("shard", F.least(F.floor(middle).cast("int"), F.lit(n - 1))))
    firsts = F.broadcast(numbered.groupBy("shard").agg(F.min("_at").alias("_first")))  # one row a shard
    return numbered.join(firsts, "shard").select(*keep, "size", "shard", (F.col("_at") - F.col("_first")).alias("slot"))


def shard(docs: DataFrame, n: int = SHARDS, seed: int = 1) -> DataFrame:
    """docs with the columns shard and slot, all other columns as they are."""
    docs = docs.drop("shard", "slot")
    placed = shards(docs.withColumn("_row", row_key(docs)), ["_row"], n, seed=seed)
    return attach(docs, placed.drop("size"))
