"""What the operators share: row keys, tables in the shared folder, running sums."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.catalog.session import work_folder


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: no task behind it runs again."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that run inside send at most so many rows at a time to Python; for whole texts, whose batches are else large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(int(was), most) if int(was) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(name, was)


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def _holds_map(kind: T.DataType) -> bool:
    """Whether values of the type have no hash of their own: maps and variants, at any depth."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_key(df: DataFrame) -> Column:
    """128 bits that only rows equal in every column share.

    Columns that hold maps or variants count by their JSON, so equal maps whose
    entries stand in another order are taken for different, never different
    ones for equal.
    """
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    cols = [F.to_json(F.struct(F.col(f"`{f.name}`")), options) if _holds_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema]
    # A null and a missing neighbour must not look alike, so each column says whether it is null.
    marked = [x for c in cols for x in (c.isNull(), c)]
    return F.struct(F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit(7), *reversed(marked)).alias("b"))


def attach(docs: DataFrame, narrow: DataFrame, key: str = "_row") -> DataFrame:
    """Give narrow rows, one for each row of docs and named by row_key, the columns of docs.

    Rows equal in all columns meet as one before the join, so repeated rows
    are joined once to each of their narrow rows and never to each other's.
    """
    held = docs.select(row_key(docs).alias(key), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    once = held.dropDuplicates([key])
    rest = [c for c in narrow.columns if c != key]
    return once.join(narrow, key).select("_doc.*", *rest)


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Number the rows of each group from 1 (``_rank``) over the whole table.

    Ranges of (group, order) are written with the number of their partition;
    counts of ranges give each range its first number, so a group of any size
    is numbered by as many tasks as it has ranges.
    """
    cut = written(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("_part", group).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order))
    numbered = cut.withColumn("_inside", inside).join(starts, ["_part", group])
    return numbered.withColumn("_rank", F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for the nodes of ``a, b``: the smallest node each is connected with.

    Labels take the smallest of their neighbours, then jump to the label of
    their label; rounds end when nothing changes.  Only links are handled here.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        moved = written(moved.join(up, "comp").select("node", "was", F.least("comp", "up").alias("comp")))
        if moved.where("comp < was").isEmpty():
            return labels
        labels = moved.select("node", "comp")
