"""Change tracking: what is new, changed, known or gone since the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(content: Column) -> Column:
    return F.md5(content)


def twice(path: Column) -> Column:
    return F.raise_error(F.concat(F.lit("the scan holds this path twice: "), path)).cast("string")


def classify(scan: DataFrame, manifest: DataFrame) -> DataFrame:
    """``path, state, content_md5``: one row per path of either side.

    Only paths and hashes are shuffled, never contents.  Further columns of
    the manifest come along for the known, changed and removed paths.  A path
    that the scan holds twice is an error that names it.
    """
    old = manifest.withColumnRenamed("content_md5", "old_md5")
    new = scan.groupBy("path").agg(F.min("content_md5").alias("content_md5"), F.count("*").alias("n"))
    new = new.select("path", F.when(F.col("n") > 1, twice(F.col("path"))).otherwise(F.col("content_md5")).alias("content_md5"))
    state = (
        F.when(F.col("old_md5").isNull(), "NEW")
        .when(F.col("content_md5").isNull(), "REMOVED")
        .when(F.col("old_md5") == F.col("content_md5"), "KNOWN")
        .otherwise("UPDATE")
    )
    return new.join(old, "path", "full_outer").withColumn("state", state).drop("old_md5")


def removed_paths(scan: DataFrame, manifest: DataFrame) -> DataFrame:
    return manifest.join(scan.select("path"), "path", "left_anti").select("path")


def changed(changes: DataFrame) -> DataFrame:
    """The paths that have to be analysed."""
    return changes.where(F.col("state").isin("NEW", "UPDATE"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("state").agg(F.count("*").alias("n"))


def upsert(old: DataFrame, new: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same path."""
    kept = old.join(new.select("path"), "path", "left_anti")
    if gone is not None:
        kept = kept.join(gone.select("path"), "path", "left_anti")
    return kept.unionByName(new)


def select_paths(docs: DataFrame, paths: DataFrame) -> DataFrame:
    return docs.join(paths.select("path"), "path", "left_semi")
