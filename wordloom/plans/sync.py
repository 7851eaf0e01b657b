"""Bring an index in line with a scan, or apply a batch of changes to it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wordloom.operators import changes as C
from wordloom.plans.store import Commit, IndexStore
from wordloom.sources.extract import DEFAULT_EXTRACTORS, Extractor, extract, plain_text
from wordloom.sources.files import FILE_TYPES
from wordloom.sources.tree import list_files, read_files

STATES = ("NEW", "UPDATE", "KNOWN", "REMOVED")
# Up to this many paths are handed to every task, some tens of megabytes.
BROADCAST_PATHS = 200_000
# A file changed so shortly before it was listed may change again without another time.
SETTLED = timedelta(seconds=2)


class SyncResult:
    """``version`` of the index, ``counts`` per state, ``changes`` as a table."""

    def __init__(self, store: IndexStore, version: int, recorded: int, counts: Mapping[str, int]):
        self.version = version
        self.counts = {s: counts.get(s, 0) for s in STATES}
        self._store, self._recorded = store, recorded

    @property
    def indexed_count(self) -> int:
        return self.counts["NEW"] + self.counts["UPDATE"]

    @property
    def changes(self) -> DataFrame:
        """``path, state`` of what was new, updated or removed."""
        return self._store.changes(self._recorded).select("path", "state")


def sync(
    store: IndexStore,
    scan: DataFrame,
    extractors: Mapping[str, Extractor] = DEFAULT_EXTRACTORS,
    fallback: Extractor = plain_text,
) -> SyncResult:
    """Make the index hold exactly the scanned documents.

    ``scan`` has ``path, text`` and may have ``bytes`` (hashed instead of the
    text), ``doc_id`` and ``title, content`` (then nothing is extracted).
    Paths of the index that the scan lacks are removed; a path that occurs
    twice is an error.
    """
    at = store.commit()
    hashed = _hashed(scan)
    if not at.segments:
        return _first_load(store, at, hashed, extractors, fallback)
    found = C.classify(hashed.select("path", "content_md5"), _manifest_with_ids(store, at))
    return _apply(store, at, hashed, found, extractors, fallback)


def sync_tree(
    store: IndexStore,
    folder: str,
    file_types: Iterable[str] = FILE_TYPES,
    charset: str = "UTF-8",
    extractors: Mapping[str, Extractor] = DEFAULT_EXTRACTORS,
    fallback: Extractor = plain_text,
) -> SyncResult:
    """``sync`` with a file tree, opening only files that may have changed.

    A file with the path, length and time of change of last time is taken for
    the same, unless it was changed within ``SETTLED`` of its listing or the
    index has another content for it by now; who changes files and sets their
    times back uses ``sync``.  The others are read once, into the index's work
    folder, and compared by hash; a first load stores no copy.
    """
    at, began = store.commit(), datetime.now(timezone.utc)
    work = f"{store.root}/work"
    files = list_files(store.spark, folder, work, file_types)
    number, stamps = store.stamps()
    if not at.segments:
        suspects = files
        result = _first_load(store, at, _hashed(read_files(files, folder, charset).drop("length")), extractors, fallback)
    else:
        manifest = _manifest_with_ids(store, at)
        suspects, same = files, manifest.select("path", "content_md5").limit(0)
        if stamps is not None:
            same = files.join(_shuffled(stamps), ["path", "length", "modified"])
            same = same.join(_shuffled(manifest), ["path", "content_md5"], "left_semi").select("path", "content_md5")
            suspects = files.join(_shuffled(same), "path", "left_anti")
        staged = f"{work}/suspects-{uuid.uuid4().hex}"
        read = _hashed(read_files(suspects, folder, charset).drop("length"))
        read.write.parquet(staged)
        read = store.spark.read.schema(read.schema).parquet(staged)
        found = C.classify(read.select("path", "content_md5").unionByName(same), manifest)
        result = _apply(store, at, read, found, extractors, fallback)
    if sum(result.counts.values()) > result.counts["KNOWN"] or not suspects.isEmpty():
        # After the commit: without them the next sync reads more, not less.
        settled = files.where(F.col("modified") < F.lit(began - SETTLED))
        store.stamp(settled.join(_shuffled(store.manifest()), "path"), number + 1)
    return result


def apply_feed(
    store: IndexStore,
    feed: DataFrame,
    extractors: Mapping[str, Extractor] = DEFAULT_EXTRACTORS,
    fallback: Extractor = plain_text,
) -> SyncResult:
    """Apply rows ``path, text, ts`` and, optionally, ``deleted``.

    The last version of a path wins; of versions with equal ``ts``, the one
    with the larger hash.  The index remembers the version that won, of deleted
    paths too, so an older row that comes with a later feed changes nothing.
    Paths the feed does not name stay as they are.  Applying the same feed
    again changes nothing.  ``ts`` keeps its type from feed to feed.
    """
    at = store.commit()
    if "deleted" not in feed.columns:
        feed = feed.withColumn("deleted", F.lit(False))
    others = [c for c in feed.columns if c not in ("path", "ts")]
    version = F.struct("ts", F.xxhash64(*others).alias("hash"))
    last = feed.groupBy("path").agg(F.max_by(F.struct(*others), version).alias("last"), F.max(version).alias("version"))
    seen = store.seen()
    if seen is not None:
        before = seen.join(_shuffled(last.select("path")), "path", "left_semi").groupBy("path").agg(F.max(F.struct("ts", "hash")).alias("before"))
        last = last.join(_shuffled(before), "path", "left").where(F.col("before").isNull() | (F.col("version") >= F.col("before")))
    # Stored once: finding the last versions shuffles the texts, and three jobs read what it gives.
    staged = f"{store.root}/work/feed-{uuid.uuid4().hex}"
    last = _hashed(last.select("path", "version", "last.*"))
    last.write.option("compression", "zstd").parquet(staged)
    last = store.spark.read.schema(last.schema).parquet(staged)
    hashed = last.drop("version")
    manifest = _manifest_with_ids(store, at)
    named = hashed.select("path", F.when(~F.col("deleted"), F.col("content_md5")).alias("content_md5"))
    found = C.classify(named, manifest.join(_shuffled(named.select("path")), "path", "left_semi")).where(
        F.col("content_md5").isNotNull() | F.col("doc_id").isNotNull()
    )
    result = _apply(store, at, hashed.where("not deleted").drop("deleted"), found, extractors, fallback)
    # After the commit: a run that fails before this is repeated with the same rows.
    store.remember(last.select("path", "version.*"))
    return result


def _shuffled(table: DataFrame) -> DataFrame:
    """A side of a join on paths that no plan hands to every task.

    Spark judges a stored table by its compressed bytes, and so would send
    millions of similar paths through the driver.
    """
    return table.hint("merge")


def _hashed(scan: DataFrame) -> DataFrame:
    source = "bytes" if "bytes" in scan.columns else "text" if "text" in scan.columns else "content"
    md5 = C.fingerprint(F.coalesce(F.col(source), F.lit("").cast(scan.schema[source].dataType)))
    return scan.withColumn("content_md5", md5).drop("bytes")


def _manifest_with_ids(store: IndexStore, at: Commit) -> DataFrame:
    return store.docs(at).select("path", "content_md5", "doc_id", "segment", "file")


def _documents(todo: DataFrame, extractors, fallback) -> DataFrame:
    return extract(todo, extractors, fallback) if "text" in todo.columns else todo


def _first_load(store, at, hashed, extractors, fallback) -> SyncResult:
    """Everything is new: one pass over the contents, nothing to compare."""
    version = at.version + 1
    store.write_forward(_documents(hashed, extractors, fallback), version, at, hashed.select("path"))
    loaded = store.segment_documents(version)
    store.write_changes(
        loaded.select(
            "path",
            F.lit("NEW").alias("state"),
            F.lit(None).cast("bigint").alias("old_doc_id"),
            F.lit(None).cast("int").alias("old_segment"),
            F.lit(None).cast("string").alias("old_file"),
        ),
        version,
    )
    repeated = loaded.groupBy("path").count().where("count > 1").first()
    if repeated:
        raise ValueError(f"the scan holds this path twice: {repeated['path']}")
    counts = {"NEW": loaded.count()}
    if counts["NEW"] == 0:
        return SyncResult(store, at.version, version, counts)
    store.write_segment(version, None)
    store.publish(Commit(version, (version,), 0))
    return SyncResult(store, version, version, counts)


def _apply(store, at, hashed, found, extractors, fallback) -> SyncResult:
    version = at.version + 1

    # 1. What changed.  Known paths are counted in passing and not stored.
    seen = Observation("sync")
    events = (
        found.observe(seen, *[F.count_if(F.col("state") == s).alias(s) for s in STATES])
        .where(F.col("state") != "KNOWN")
        .select("path", "state", F.col("doc_id").alias("old_doc_id"), F.col("segment").alias("old_segment"), F.col("file").alias("old_file"))
    )
    store.write_changes(events, version)
    counts = {s: seen.get.get(s, 0) for s in STATES}
    changes = store.changes(version)
    added = counts["NEW"] + counts["UPDATE"]
    lost = counts["UPDATE"] + counts["REMOVED"]
    if added + lost == 0:
        return SyncResult(store, at.version, version, counts)

    # 2. Analyse the new and changed documents only.  Their number is known: a
    # small one is broadcast, a large one meets the texts in a shuffle by path.
    # Paths are unique, so that shuffle has no hot key.  If nothing was found
    # known, nothing else is there.
    wanted = C.changed(changes).select("path")
    if not added:
        todo = hashed.limit(0)
    elif counts["KNOWN"] == 0:
        todo = hashed.where("path is not null")
    else:
        todo = hashed.join(F.broadcast(wanted) if added <= BROADCAST_PATHS else _shuffled(wanted), "path", "left_semi")
    store.write_forward(_documents(todo, extractors, fallback), version, at, wanted)

    # 3. The other tables of the segment, with the statistics of lost
    # documents subtracted; the commit row comes last.
    gone_forward = None
    if lost:
        gone = changes.where(F.col("old_doc_id").isNotNull()).select(
            F.col("old_doc_id").alias("doc_id"), F.col("old_segment").alias("segment"), F.col("old_file").alias("file")
        )
        gone_forward = store.forward_of(at, gone)
        store.write_dead(store.dead(at).unionByName(gone.select("doc_id", "segment")), version)
    store.write_segment(version, gone_forward)
    store.publish(Commit(version, (*at.segments, version), at.n_dead + lost))
    return SyncResult(store, version, version, counts)


def compact(store: IndexStore) -> int:
    """Rewrite the live documents as one segment, without their history."""
    at = store.commit()
    if len(at.segments) <= 1 and not at.n_dead:
        return at.version
    version = at.version + 1
    store.copy_forward(at, version)
    store.write_segment(version, None)
    store.publish(Commit(version, (version,), 0))
    return version
