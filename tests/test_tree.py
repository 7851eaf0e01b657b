"""Trees listed by tasks, and syncs that open only what has another stamp."""

import os
from pathlib import Path

import pytest
from conftest import write_files
from wordloom.plans.store import IndexStore
from wordloom.plans.sync import apply_feed, sync, sync_tree
from wordloom.sources.files import scan_files
from wordloom.catalog import queries
from wordloom.sources.tree import list_files, read_files, scan_tree

TREE = {
    "a.txt": "one",
    "_b.txt": "two",
    ".c.HTM": "three",
    "_d/e.txt": "four",
    ".f/.g/_h.html": "",
    "x=1/i.txt": "six",
    "odd %20 #name?.txt": "ä",
    "skip.md": "no",
    "_d/.DS_Store": "no",
}


def test_hidden_names(spark, tmp_path):
    folder = write_files(tmp_path / "t", TREE)
    (tmp_path / "t" / "empty" / "_more").mkdir(parents=True)
    wanted = {f"{folder}/{n}": t for n, t in TREE.items() if not n.endswith(("md", "Store"))}
    for address in (folder, folder + "/", "file:" + folder, "file://" + folder):
        found = scan_tree(spark, address, str(tmp_path / "w")).collect()
        assert {r["path"]: r["text"] for r in found} == wanted and len(found) == len(wanted)
        assert all(bytes(r["bytes"]).decode() == r["text"] for r in found)
    listed = {r["path"]: r for r in list_files(spark, folder, str(tmp_path / "w")).collect()}
    assert {p: r["length"] for p, r in listed.items()} == {p: len(t.encode()) for p, t in wanted.items()}
    assert list_files(spark, folder, str(tmp_path / "w"), [".md"]).count() == 1


def test_same_as_the_plain_scan(spark, sample_folder, tmp_path):
    plain = {r["path"]: r["text"] for r in scan_files(spark, sample_folder).collect()}
    assert {r["path"]: r["text"] for r in scan_tree(spark, sample_folder, str(tmp_path / "w")).collect()} == plain


def test_empty_missing_and_gone(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert scan_tree(spark, str(tmp_path / "t"), str(tmp_path / "w")).collect() == []
    with pytest.raises(Exception, match="nowhere"):
        list_files(spark, str(tmp_path / "nowhere"), str(tmp_path / "w"))
    folder = write_files(tmp_path / "t", {"a.txt": "x", "b.txt": "y"})
    files = list_files(spark, folder, str(tmp_path / "w"))
    (tmp_path / "t" / "a.txt").unlink()
    assert [r["text"] for r in read_files(files, folder).collect()] == ["y"]


def test_links(spark, tmp_path):
    folder = Path(write_files(tmp_path / "t", {"a/x.txt": "1", "b/y.txt": "2"}))
    other = write_files(tmp_path / "o", {"z.txt": "3"})
    os.symlink(other, folder / "a" / "other")
    os.symlink(folder, folder / "a" / "up")
    os.symlink(folder / "a", folder / "b" / "side")
    os.symlink(folder / "b", folder / "a" / "side")
    os.symlink(folder / "none", folder / "broken.txt")
    found = {r["path"][len(str(folder)) + 1 :] for r in list_files(spark, str(folder), str(tmp_path / "w")).collect()}
    assert found == {
        "a/x.txt", "a/other/z.txt", "a/side/y.txt", "b/y.txt", "b/side/x.txt", "b/side/other/z.txt",
    }


def test_charset(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "latin.txt").write_bytes("é".encode("latin-1"))
    read = [scan_tree(spark, str(tmp_path / "t"), str(tmp_path / "w"), charset=c).first()["text"] for c in ("ISO-8859-1", "utf-8")]
    assert read == ["é", "�"]


def put(path, text, seconds):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (seconds, seconds))


def texts(store):
    return {Path(r["path"]).name: r["content_md5"] for r in store.docs().collect()}


def counted(result):
    return tuple(result.counts[s] for s in ("NEW", "UPDATE", "KNOWN", "REMOVED"))


def test_sync_opens_only_other_stamps(spark, tmp_path):
    folder = tmp_path / "t"
    for name in ("a.txt", "_b.txt", ".c/d.txt", "e.txt", "f.txt"):
        put(folder / name, "bread " + name, 1_000_000)
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    assert counted(sync_tree(store, str(folder))) == (5, 0, 0, 0)
    first = store.commit().version

    # A text of the same length under the old time: that it goes unseen shows that no file was opened.
    put(folder / "a.txt", "BREAD a.txt", 1_000_000)
    before = texts(store)
    assert counted(sync_tree(store, str(folder))) == (0, 0, 5, 0)
    assert texts(store) == before and store.commit().version == first

    put(folder / "a.txt", "BREAD a.txt", 1_000_001)  # another time
    put(folder / "_b.txt", "bread and more", 1_000_000)  # another length
    put(folder / "e.txt", "bread e.txt", 1_000_002)  # another time, same text
    put(folder / "g.txt", "new", 1_000_000)
    (folder / "f.txt").unlink()
    assert counted(sync_tree(store, str(folder))) == (1, 2, 2, 1)
    assert counted(sync_tree(store, str(folder))) == (0, 0, 5, 0)
    plain = IndexStore(spark, str(tmp_path / "plain"), buckets=2, shards=2)
    sync_tree(plain, str(folder))
    assert texts(store) == texts(plain)

    # What another way has put into the index is seen, though the file is as it was.
    feed = spark.createDataFrame([(str(folder / "g.txt"), "by feed", 1)], "path string, text string, ts int")
    assert counted(apply_feed(store, feed)) == (0, 1, 0, 0)
    assert counted(sync_tree(store, str(folder))) == (0, 1, 4, 0)
    assert texts(store) == texts(plain)


def test_sync_does_not_trust_fresh_files(spark, tmp_path):
    folder = tmp_path / "t"
    put(folder / "a.txt", "one", 4_000_000_000)
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync_tree(store, str(folder))
    put(folder / "a.txt", "two", 4_000_000_000)
    assert counted(sync_tree(store, str(folder))) == (0, 1, 0, 0)
    (folder / "a.txt").unlink()
    assert counted(sync_tree(store, str(folder))) == (0, 0, 0, 1)
    assert counted(sync_tree(store, str(folder))) == (0, 0, 0, 0)


def test_sync_tree_gives_what_sync_gives(spark, sample_folder, tmp_path):
    one, two = (IndexStore(spark, str(tmp_path / n), buckets=2, shards=2) for n in ("one", "two"))
    assert sync_tree(one, sample_folder).counts == sync(two, scan_files(spark, sample_folder)).counts
    assert texts(one) == texts(two)


def test_scan_tree_query_joins_nothing(spark):
    """The lengths come along with the contents: no side could be sent through the driver."""
    found = queries.scan_tree(spark, "/root/testdata/sf0.001")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("length is null").isEmpty() and not found.isEmpty()
