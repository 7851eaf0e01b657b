"""Incremental ingest: a stream of changes drives the index.

A file stream cannot see a vanished file and does not re-read a rewritten
one, so deletions and new versions arrive as rows of the feed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wordloom.plans.store import IndexStore
from wordloom.plans.sync import apply_feed
from wordloom.sources.extract import DEFAULT_EXTRACTORS, Extractor, plain_text


def read_feed(spark, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def ingest(
    store: IndexStore,
    feed: DataFrame,
    checkpoint: str,
    extractors: Mapping[str, Extractor] = DEFAULT_EXTRACTORS,
    fallback: Extractor = plain_text,
) -> StreamingQuery:
    """Apply all available batches of ``path, text, ts[, deleted]`` and stop.

    A batch that is replayed after a failure finds its documents known, so it
    changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_feed(store, batch, extractors, fallback)

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
