"""Top-k and the shape of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.sources.files import file_name

# Default settings.
RESULT_COUNT = 10


def check_k(k: int) -> int:
    if k < 1:
        raise ValueError(f"the number of results must be at least 1, not {k}")
    return k


def _best_first(*keys: str):
    return Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")


def top_k(scored: DataFrame, k: int = RESULT_COUNT, single_query: bool = False) -> DataFrame:
    """Best k documents per query with their 1-based rank.

    Ties go to the lower ``doc_id``.  Each task keeps k rows per query before
    anything is shuffled, in both forms.
    """
    check_k(k)
    if single_query:
        scored = scored.orderBy(F.desc("score"), "doc_id").limit(k)
    rank = F.row_number().over(_best_first("query_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def is_html(path: Column) -> Column:
    name = F.lower(file_name(path))
    return F.endswith(name, F.lit(".html")) | F.endswith(name, F.lit(".htm"))


def with_stored_fields(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Add path, title, file name, and the title to show (HTML only)."""
    joined = hits.join(docs, [c for c in ("doc_id", "shard") if c in hits.columns and c in docs.columns])
    return joined.select(
        "query_id",
        "rank",
        "score",
        "doc_id",
        "path",
        "title",
        file_name(F.col("path")).alias("file_name"),
        F.when(is_html(F.col("path")), F.col("title")).alias("display_title"),
    )
