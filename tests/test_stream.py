from pyspark.sql import functions as F
from test_sync import content_of

from wordloom.plans.store import IndexStore
from wordloom.plans.sync import apply_feed, sync
from wordloom.streaming.ingest import ingest, read_feed

SCHEMA = "path string, text string, ts int, deleted boolean"
FIRST = [("a.txt", "one test", 1, False), ("b.txt", "two", 1, False), ("a.txt", "one later test", 2, False)]
SECOND = [("b.txt", None, 3, True), ("c.html", "<title>t</title>three", 3, False), ("x.txt", None, 3, True)]


def test_two_batches_equal_one_sync(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    feed = str(tmp_path / "feed")
    for rows in (FIRST, SECOND):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(feed)
        ingest(store, read_feed(spark, feed, SCHEMA), str(tmp_path / "checkpoint")).awaitTermination()

    whole = IndexStore(spark, str(tmp_path / "whole"), buckets=2, shards=2)
    final = [("a.txt", "one later test"), ("c.html", "<title>t</title>three")]
    sync(whole, spark.createDataFrame(final, "path string, text string"))
    assert content_of(store) == content_of(whole)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    batch = spark.createDataFrame(FIRST, SCHEMA)
    assert apply_feed(store, batch).counts["NEW"] == 2
    before = store.commit()
    again = apply_feed(store, batch)
    assert again.counts == {"NEW": 0, "UPDATE": 0, "KNOWN": 2, "REMOVED": 0}
    assert store.commit() == before


def test_unnamed_paths_stay(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    apply_feed(store, spark.createDataFrame(FIRST, SCHEMA))
    only = spark.createDataFrame([("z.txt", "more", 9)], "path string, text string, ts int")
    assert apply_feed(store, only).counts == {"NEW": 1, "UPDATE": 0, "KNOWN": 0, "REMOVED": 0}
    assert {r["path"] for r in store.docs().select(F.col("path")).collect()} == {"a.txt", "b.txt", "z.txt"}


def texts(store):
    return {r["path"]: r["content_md5"] for r in store.docs().collect()}


def test_late_rows_change_nothing(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    feed = lambda *rows: apply_feed(store, spark.createDataFrame(rows, SCHEMA))
    feed(("a.txt", "newest", 5, False), ("b.txt", None, 5, True), ("c.txt", "one", 1, False))
    before = content_of(store)
    late = feed(("a.txt", "older", 2, False), ("b.txt", "late write", 4, False), ("c.txt", None, 0, True))
    assert late.counts == {"NEW": 0, "UPDATE": 0, "KNOWN": 0, "REMOVED": 0}
    assert content_of(store) == before
    # A version that changes no text is remembered too.
    feed(("c.txt", "one", 7, False))
    feed(("c.txt", "two", 6, False))
    assert content_of(store) == before
    feed(("b.txt", "back", 6, False), ("c.txt", "two", 8, False))
    whole = IndexStore(spark, str(tmp_path / "whole"), buckets=2, shards=2)
    final = [("a.txt", "newest"), ("b.txt", "back"), ("c.txt", "two")]
    sync(whole, spark.createDataFrame(final, "path string, text string"))
    assert content_of(store) == content_of(whole)


def test_equal_times_in_two_feeds(spark, tmp_path):
    rows = [("a.txt", "one", 3, False), ("a.txt", "two", 3, False)]
    stores = [IndexStore(spark, str(tmp_path / f"index{i}"), buckets=2, shards=2) for i in range(2)]
    for store, order in zip(stores, (rows, rows[::-1])):
        for row in order:
            apply_feed(store, spark.createDataFrame([row], SCHEMA))
    assert texts(stores[0]) == texts(stores[1])


def test_tables_without_segments_start_no_python(spark, tmp_path):
    docs = IndexStore(spark, str(tmp_path / "index")).docs()
    assert "ExistingRDD" not in docs._jdf.queryExecution().executedPlan().toString() and docs.count() == 0
