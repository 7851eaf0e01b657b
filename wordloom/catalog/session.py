"""Stored indexes of the given tables, one per application and table folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.plans.store import IndexStore, folders_for
from wordloom.plans.sync import sync
from wordloom.sources.files import documents_corpus, pages_scan, spread

_stores: dict[tuple[str, str, str], IndexStore] = {}
_own_folder: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """A new folder under the shared one that the session names.

    A local session that names none, as in tests, gets a temporary folder; on
    a cluster such a folder would be seen by one machine only, so it is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="wordloom-"))
        shared = _own_folder[0]
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def _store(spark: SparkSession, sf_dir: str, corpus: str, make) -> IndexStore:
    key = (spark.sparkContext.applicationId, sf_dir, corpus)
    if key not in _stores:
        n = folders_for(spark, f"{sf_dir}/{corpus}.parquet")
        store = IndexStore(spark, work_folder(spark), buckets=n, shards=max(8, n // 4))
        sync(store, spread(make(spark, sf_dir), "doc_id"))
        _stores[key] = store
    return _stores[key]


def documents_index(spark: SparkSession, sf_dir: str) -> IndexStore:
    return _store(spark, sf_dir, "documents", documents_corpus)


def _numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under ``page_id/url``, or the number alone: several pages may have one address, an index has a path once."""
    path = F.concat_ws("/", F.col("doc_id").cast("string"), "path")
    return pages_scan(spark, sf_dir).withColumn("path", path)


def pages_index(spark: SparkSession, sf_dir: str) -> IndexStore:
    """The paths of this index begin with the number of the page."""
    return _store(spark, sf_dir, "pages", _numbered_pages)
