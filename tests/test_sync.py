from pathlib import Path

import pytest
from conftest import FILES, write_files
from pyspark.sql import functions as F

from wordloom.operators.clauses import term
from wordloom.plans.search import Searcher
from wordloom.plans.store import IndexStore
from wordloom.plans.sync import apply_feed, compact, sync, sync_tree
from wordloom.sources.files import scan_files
from wordloom.sources.extract import DEFAULT_EXTRACTORS


def counts(new=0, update=0, known=0, removed=0):
    return {"NEW": new, "UPDATE": update, "KNOWN": known, "REMOVED": removed}


def names(df):
    return {(Path(r["path"]).name, r["state"]) for r in df.collect()}


def content_of(store):
    """Everything a reader can see, without document numbers."""
    docs = store.docs()
    paths = docs.select("doc_id", "path")
    postings = store.postings().drop("segment", "bucket", "lead").join(paths, "doc_id").drop("doc_id")
    return {
        "docs": sorted(map(tuple, docs.select("path", "title", "content_md5").collect())),
        "postings": sorted(map(repr, postings.select(*sorted(postings.columns)).collect())),
        "terms": sorted(map(tuple, store.terms().select("field", "term", "df", "ttf").collect())),
        "fields": sorted(map(tuple, store.field_stats().select("field", "doc_count", "sum_dl").collect())),
    }


def fresh(spark, folder, root):
    store = IndexStore(spark, root, buckets=3, shards=2)
    sync(store, scan_files(spark, folder))
    return content_of(store)


def test_life_of_an_index(spark, sample_folder, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=3, shards=2)

    first = sync(store, scan_files(spark, sample_folder))
    assert first.counts == counts(new=6)
    assert first.indexed_count == 6
    assert names(first.changes) == {(Path(f).name, "NEW") for f in FILES}
    before = content_of(store)
    assert before["fields"] == [("content", 5, 34), ("title", 6, 10)]

    again = sync(store, scan_files(spark, sample_folder))
    assert again.counts == counts(known=6)
    assert again.version == first.version
    assert content_of(store) == before

    folder = Path(sample_folder)
    folder.joinpath("bread.txt").write_text("a different text")
    folder.joinpath("oven.txt").rename(folder / "oven.bak")
    folder.joinpath("New.txt").write_text("brand new test")
    changed = sync(store, scan_files(spark, sample_folder))
    assert changed.counts == counts(new=1, update=1, known=4, removed=1)
    assert changed.indexed_count == 2
    assert names(changed.changes) == {("bread.txt", "UPDATE"), ("oven.txt", "REMOVED"), ("New.txt", "NEW")}
    after = content_of(store)
    assert after == fresh(spark, sample_folder, str(tmp_path / "fresh"))

    compact(store)
    assert len(store.commit().segments) == 1
    assert content_of(store) == after

    fewer = sync(store, scan_files(spark, sample_folder, [".txt"]))
    assert fewer.counts == counts(known=4, removed=2)

    folder.joinpath("bread.txt").rename(folder / "Hi.txt")
    renamed = sync(store, scan_files(spark, sample_folder, [".txt"]))
    assert renamed.counts == counts(new=1, known=3, removed=1)

    (tmp_path / "empty").mkdir()
    emptied = sync(store, scan_files(spark, str(tmp_path / "empty")))
    assert emptied.counts == counts(removed=4)
    assert content_of(store) == {"docs": [], "postings": [], "terms": [], "fields": []}
    assert Searcher(store).search([term("test")]).collect() == []

    back = sync(store, scan_files(spark, sample_folder, [".txt"]))
    assert back.counts == counts(new=4)


def test_failed_run_leaves_nothing_visible(spark, sample_folder, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, scan_files(spark, sample_folder))
    before = content_of(store)
    Path(sample_folder, "New.txt").write_text("new")
    with monkeypatch.context() as m:
        m.setattr(IndexStore, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sync(store, scan_files(spark, sample_folder))
    assert content_of(store) == before
    assert sync(store, scan_files(spark, sample_folder)).counts == counts(new=1, known=6)
    assert content_of(store) == fresh(spark, sample_folder, str(tmp_path / "fresh"))


def test_empty_folder_first(spark, tmp_path):
    (tmp_path / "nothing").mkdir()
    store = IndexStore(spark, str(tmp_path / "index"))
    assert sync(store, scan_files(spark, str(tmp_path / "nothing"))).counts == counts()
    assert Searcher(store).search([term("test")]).collect() == []


def test_scan(spark, tmp_path):
    folder = write_files(tmp_path / "d", {"A.TXT": "x", "b.html": "y", "c.md": "z", "sub/d.HtM": "w", "etxt": "v"})
    found = {Path(r["path"]).name for r in scan_files(spark, folder).collect()}
    assert found == {"A.TXT", "b.html", "d.HtM"}
    # The test is a plain suffix: no dot needed.
    assert {Path(r["path"]).name for r in scan_files(spark, folder, ["txt"]).collect()} == {"A.TXT", "etxt"}


def test_charset(spark, tmp_path):
    (tmp_path / "latin.txt").write_bytes("é".encode("latin-1"))
    assert scan_files(spark, str(tmp_path), charset="ISO-8859-1").first()["text"] == "é"
    assert scan_files(spark, str(tmp_path)).first()["text"] == "�"


def test_longest_suffix_extractor(spark, tmp_path):
    def special(path, text):
        return F.lit("special"), text

    folder = write_files(tmp_path / "d", {"a.x.html": "<title>t</title>one", "b.html": "<title>t</title>two"})
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, scan_files(spark, folder), {**DEFAULT_EXTRACTORS, ".x.html": special})
    assert {Path(r["path"]).name: r["title"] for r in store.docs().collect()} == {"a.x.html": "special", "b.html": "t"}


def test_sum_of_tf_is_sum_of_lengths(spark, sample_folder, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, scan_files(spark, sample_folder))
    postings = store.postings()
    assert postings.agg(F.sum("tf")).first()[0] == postings.where("lead").agg(F.sum("dl")).first()[0]


def test_layout_is_stored(spark, sample_folder, tmp_path):
    root = str(tmp_path / "index")
    sync(IndexStore(spark, root, buckets=3, shards=2), scan_files(spark, sample_folder))
    plain = IndexStore(spark, root)
    assert (plain.buckets, plain.shards) == (3, 2)
    assert len(Searcher(plain).search([term("dough")]).collect()) == 3
    for other in ({"buckets": 5}, {"shards": 9}, {"fields": ["content"]}):
        with pytest.raises(ValueError, match="the index at"):
            IndexStore(spark, root, **other)


def test_path_twice_is_refused(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    once, double = [("a.txt", "x")], [("b.txt", "x"), ("b.txt", "y")]
    with pytest.raises(ValueError, match="twice: b.txt"):
        sync(store, spark.createDataFrame(double, "path string, text string"))
    assert store.commit().version == 0
    sync(store, spark.createDataFrame(once, "path string, text string"))
    with pytest.raises(Exception, match="twice: b.txt"):
        sync(store, spark.createDataFrame(once + double, "path string, text string"))
    assert store.commit().version == 1


def test_update_reads_only_the_files_of_changed_documents(spark, tmp_path, monkeypatch):
    rows = [(f"{i:03}.txt", f"word{i} and common") for i in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, "path string, text string").repartitionByRange(8, "path")
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, frame(rows))
    read = []
    forward_of = IndexStore.forward_of
    monkeypatch.setattr(IndexStore, "forward_of", lambda *a: read.append(forward_of(*a)) or read[-1])
    changed = [("001.txt", "another"), *rows[:1], *rows[2:-1]]
    assert sync(store, frame(changed)).counts == counts(update=1, known=198, removed=1)
    assert len([f for f in read[0].inputFiles() if "/forward/" in f]) == 2 and read[0].count() == 2
    monkeypatch.setattr("wordloom.plans.store.NAMED_FILES", 1)
    assert sync(store, frame(changed[1:-1])).counts == counts(known=197, removed=2)
    whole = IndexStore(spark, str(tmp_path / "whole"), buckets=2, shards=2)
    sync(whole, frame(changed[1:-1]))
    assert content_of(store) == content_of(whole)


def test_paths_that_share_a_number(spark, tmp_path, monkeypatch):
    """With three first numbers only, most paths have to move."""
    monkeypatch.setattr("wordloom.plans.store.path_number", lambda path, attempt: F.pmod(F.xxhash64(path, F.lit(attempt)), F.lit(3 if attempt == 0 else 5 if attempt == 1 else 1 << 40)))
    frame = lambda rows: spark.createDataFrame(rows, "path string, text string")
    rows = [(f"{i}.txt", f"word{i} common") for i in range(30)]
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, frame(rows[:20]))
    first = {r["path"]: r["doc_id"] for r in store.docs().collect()}
    assert len(set(first.values())) == 20
    changed = [(p, t + " changed") for p, t in rows[5:]]
    sync(store, frame(rows[:3] + changed))
    now = {r["path"]: r["doc_id"] for r in store.docs().collect()}
    assert len(set(now.values())) == len(now) == 28
    assert all(now[p] == first[p] for p, _ in rows[:3])
    monkeypatch.undo()
    whole = IndexStore(spark, str(tmp_path / "whole"), buckets=2, shards=2)
    sync(whole, frame(rows[:3] + changed))
    assert content_of(store) == content_of(whole)


def test_numbers_do_not_depend_on_partitions(spark, tmp_path):
    numbers = []
    for n in (1, 7):
        store = IndexStore(spark, str(tmp_path / f"index{n}"), buckets=2, shards=2)
        sync(store, spark.createDataFrame([(f"{i}.txt", "x") for i in range(20)], "path string, text string").repartition(n))
        numbers.append({r["path"]: r["doc_id"] for r in store.docs().collect()})
    assert numbers[0] == numbers[1]


def test_paths_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    """However few bytes they have as stored."""
    folder = write_files(tmp_path / "tree", {"a.txt": "one", "b.txt": "two"})
    store, seen = IndexStore(spark, str(tmp_path / "stamped")), []
    monkeypatch.setattr(store, "stamp", lambda files, number: seen.append(files))
    sync_tree(store, folder)
    assert "SortMergeJoin" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_a_feed_is_grouped_once(spark, tmp_path, monkeypatch):
    store, seen = IndexStore(spark, str(tmp_path / "fed")), []
    monkeypatch.setattr(store, "remember", seen.append)
    feed = spark.createDataFrame([("a", "one", 1), ("a", "two", 2), ("b", "x", 1)], "path string, text string, ts int")
    assert apply_feed(store, feed, extractors={}).counts["NEW"] == 2
    assert "Aggregate" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["path"], r["ts"]) for r in seen[0].collect()) == [("a", 2), ("b", 1)]
