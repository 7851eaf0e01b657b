"""Document sources: file trees and tables.

A corpus is a DataFrame ``path, title, content`` plus, if the source has one,
a ``doc_id`` of its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default settings.
FILE_TYPES = (".txt", ".htm", ".html")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_type(path: Column, file_types: Iterable[str] = FILE_TYPES) -> Column:
    """True where the file name ends, in any case, with one of the types."""
    name = F.lower(file_name(path))
    test = F.lit(False)
    for file_type in sorted(file_types):
        test = test | F.endswith(name, F.lit(file_type.lower()))
    return test


def scan_files(
    spark: SparkSession,
    folder: str,
    file_types: Iterable[str] = FILE_TYPES,
    charset: str = "UTF-8",
) -> DataFrame:
    """Every file of the tree with a wanted type: ``path, bytes, text``.

    The type test runs on the file listing, before any file is opened, and the
    bytes of a file are read only where a later step uses them.  Malformed
    UTF-8 becomes U+FFFD; other charsets are decoded strictly.  Spark's listing
    leaves out names that begin with ``_`` or ``.``; ``tree.scan_tree`` has them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{" + ",".join("*" + _any_case(t) for t in sorted(file_types)) + "}")
        .load(folder)
    )
    return files.where(has_type(F.col("path"), file_types)).select(
        # One spelling per file, whatever the scheme prefix of the listing.
        F.regexp_replace("path", "^file:/+", "/").alias("path"),
        F.col("content").alias("bytes"),
        decoded(F.col("content"), charset).alias("text"),
    )


def decoded(content: Column, charset: str) -> Column:
    if charset.upper() == "UTF-8":
        return F.make_valid_utf8(content.cast("string"))
    return F.decode(content, charset)


def _any_case(file_type: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in file_type)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on a small input; leave a large one as it is read.

    Text analysis is bound by CPU, and a table of a few files gives too few
    scan tasks for it, some of them empty where a file has few row groups.
    From two scan tasks per core on this adds no shuffle.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < wanted else df


def documents_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The ``documents`` table as a plain text corpus."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    title = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select(
        "doc_id",
        F.concat("source", F.lit("/"), title).alias("path"),
        title.alias("title"),
        F.col("text").alias("content"),
    )


def pages_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The ``pages`` table in the shape of a scan: ``doc_id, path, text``."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select(
        F.col("page_id").alias("doc_id"), F.col("url").alias("path"), F.col("html").alias("text")
    )
