"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import attach, positions, row_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Target size of each source: ``source, source_size`` to ``source, source_size, target``.

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes by them; none gets over ``most`` times its size.  With
    sources ordered by size over weight, those that meet their limit come
    first, and the rest share what is left; the share per weight follows from
    running sums.  One row a source, so the windows without a key hold the list
    of sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_w", turn.cast("long")).withColumn("_limit", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").isNull(), "source")
    s = s.withColumn("_used", F.coalesce(F.sum("_limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("_left", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    everything = Window.partitionBy()
    s = s.withColumn("_share", (F.sum("source_size").over(everything) - F.col("_used")) / F.col("_left"))
    # Shares rise along this order while limits are met and fall from then on: the largest is the common one.
    s = s.withColumn("_common", F.max("_share").over(everything))
    target = F.least(F.col("_limit").cast("double"), F.col("_common") * F.col("_w"))
    return s.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def copies(docs: DataFrame, keep: list[str], seed: int = 1, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Copies of each document in the mix: ``keep``, source, size, source_size, target, copies.

    A document expects target / source_size copies.  Along its source, ordered
    by size and id, the expected copies are summed from one random offset, and
    a document is taken once for each whole number its interval holds.  Order
    by size makes the words taken follow the target closely.  Rows of one size
    and id stand in the order of a hash of their text and kept columns, and the
    offset is a hash of seed and source, so reruns agree, also under another
    partitioning.  Null texts have size 0; rows without a source form one of
    their own; repeated rows count each.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    cols = list(dict.fromkeys([*keep, "doc_id"]))
    tie = row_key(docs.select(*dict.fromkeys([*cols, "text"])))
    rows = docs.select(*cols, F.col("source").alias("_source"), size.alias("size"), tie.alias("_tie"))
    rows = rows.withColumn("_group", F.when(F.col("_source").isNull(), "n").otherwise(F.concat(F.lit("v"), "_source")))
    ranked = positions(rows, "_group", ["size", "doc_id", "_tie"])
    sizes = ranked.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, most).withColumn(
        "_group", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source"))
    )
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), "_group").cast("binary")), 1, 8), 16, 10).cast("long")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    both = ranked.join(plan, "_group").withColumn("_u", offset / F.lit(2.0**32)).withColumn("_rate", rate)
    crossed = F.floor(F.col("_u") + F.col("_rate") * F.col("_rank")) - F.floor(F.col("_u") + F.col("_rate") * (F.col("_rank") - 1))
    return both.select(*cols, "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = 1, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: docs with each row as often as it is taken, other columns as they are."""
    counted = copies(docs.withColumn("_row", row_key(docs)), ["_row"], seed, weights, most)
    taken = counted.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row")
    return attach(docs, taken)
