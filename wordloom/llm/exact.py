"""Exact dedup: cuckoo filters over digest buckets, hits verified against stored keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import whole, written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLOTS = 4
MAX_KICKS = 200
# Rows for which one digest bucket is laid out; a bucket is one index in one task.
BUCKET_ROWS = 50_000


class CuckooIndex:
    """Live digests of one bucket: fingerprints in a cuckoo table, each with the place of its key.

    A key may lie in two cells; a fingerprint equal there is only a hint and is
    verified against the stored key.  If an insertion finds no place after
    MAX_KICKS moves, the table doubles and is filled again from the keys.
    """

    def __init__(self, cells: int = 64):
        self.keys: list[bytes | None] = []
        self.free: list[int] = []
        self._clear(cells)

    def _clear(self, cells: int) -> None:
        self.mask = cells - 1
        self.prints = [0] * (cells * SLOTS)
        self.place = [0] * (cells * SLOTS)
        self.kick = 0

    def _cells(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "big") or 1
        one = int.from_bytes(key[:8], "big") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, cell: int, mark: int) -> int:
        return (cell ^ (mark * 0x5BD1E995)) & self.mask

    def find(self, key: bytes) -> int:
        """Place of the key, or -1."""
        slot = self._slot(key)
        return -1 if slot < 0 else self.place[slot]

    def _slot(self, key: bytes) -> int:
        mark, one, two = self._cells(key)
        for cell in (one, two):
            for slot in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[self.place[slot]] == key:
                    return slot
        return -1

    def insert(self, key: bytes) -> tuple[int, bool]:
        """(place, whether it is new)."""
        at = self.find(key)
        if at >= 0:
            return at, False
        if self.free:
            at = self.free.pop()
            self.keys[at] = key
        else:
            at = len(self.keys)
            self.keys.append(key)
        if not self._put(key, at):
            self._grow()
        return at, True

    def _put(self, key: bytes, at: int) -> bool:
        mark, one, two = self._cells(key)
        for cell in (one, two):
            for slot in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.place[slot] = mark, at
                    return True
        cell = two
        for _ in range(MAX_KICKS):
            slot = cell * SLOTS + self.kick
            self.kick = (self.kick + 1) % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            at, self.place[slot] = self.place[slot], at
            cell = self._other(cell, mark)
            for free in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if not self.prints[free]:
                    self.prints[free], self.place[free] = mark, at
                    return True
        return False  # the one left over is still among the keys

    def _grow(self) -> None:
        cells = 2 * (self.mask + 1)
        while True:
            self._clear(cells)
            if all(self._put(k, at) for at, k in enumerate(self.keys) if k is not None):
                return
            cells *= 2

    def delete(self, key: bytes) -> int:
        """Forget the key; its former place, or -1 if it was not there."""
        slot = self._slot(key)
        if slot < 0:
            return -1
        at = self.place[slot]
        self.prints[slot] = 0
        self.keys[at] = None
        self.free.append(at)
        return at


def normalised(text: str | Column = "text") -> Column:
    return F.translate(whole(text), _UPPER, _UPPER.lower())


def _buckets(rows: int, df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


def _bucket(digest: str, n: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(n)).cast("int")


def groups(rows: DataFrame) -> DataFrame:
    """Groups of equal digests: rows ``digest, doc_id, seq`` to ``digest, keep_id, keep_seq, group_size``.

    Tasks fold their own repeats first, so a digest that a third of all rows
    share reaches its bucket as a few rows.  Buckets are walked one after the
    other in sorted partitions, each with an index of its own, so a task holds
    the distinct digests of one bucket.
    """
    n = _buckets(rows.count(), rows)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values(["doc_id", "seq"], na_position="first")
            g = b.groupby("digest", sort=False)
            last = b.drop_duplicates("digest", keep="last").set_index("digest")
            last["n"] = g.size()
            yield last.reset_index()[["digest", "doc_id", "seq", "n"]]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, index, best, size = None, CuckooIndex(), [], []

        def out():
            ids = pd.array([b[1] if b[0] else None for b in best], dtype="Int64")
            return pd.DataFrame({"digest": index.keys, "keep_id": ids, "keep_seq": [b[2] for b in best], "group_size": size})

        for b in batches:
            has = b.doc_id.notna().to_numpy()
            ids = b.doc_id.fillna(0).astype("int64")
            for k, digest, known, doc_id, seq, count in zip(b.bucket, b.digest, has, ids, b.seq, b.n):
                if k != bucket:
                    if best:
                        yield out()
                    bucket, index, best, size = k, CuckooIndex(), [], []
                at, new = index.insert(bytes(digest))
                mine = (known, doc_id, seq)
                if new:
                    best.append(mine)
                    size.append(count)
                else:
                    best[at] = max(best[at], mine)
                    size[at] += count
        if best:
            yield out()

    folded = rows.mapInPandas(fold, "digest binary, doc_id long, seq long, n long")
    dealt = folded.withColumn("bucket", _bucket("digest", n)).repartition(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(walk, "digest binary, keep_id long, keep_seq long, group_size long")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after lower-casing A-Z, null counting as empty.
    The row with the largest doc_id stays; rows without an id stay only if
    their group has none with one, and of rows tied in doc_id exactly one
    stays.  An empty table gives no rows.
    """
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    both = rows.join(groups(rows), "digest")
    return both.select(
        "doc_id", "keep_id", "group_size", (F.col("seq") == F.col("keep_seq")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def update(index: DataFrame | None, changes: DataFrame, buckets: int) -> DataFrame:
    """The index after insertions and deletions: ``digest, live`` (rows that hold it) of live digests.

    ``changes`` has ``digest`` and ``step``: 1 for a row that came, -1 for one
    that went.  Deletions of what is not there change nothing; steps for one
    digest add up in any order.  Each bucket is its own task: its filter is
    filled from the stored keys, grows with them, and forgets digests at 0.
    """
    spark = changes.sparkSession
    if index is None:
        index = spark.createDataFrame([], "digest binary, live long")
    summed = changes.groupBy("digest").agg(F.sum("step").cast("long").alias("step"))

    def apply(key, stored: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        filled, live = CuckooIndex(), []
        for digest, n in zip(stored.digest, stored.live):
            filled.insert(bytes(digest))
            live.append(n)
        for digest, step in zip(map(bytes, steps.digest), steps.step):
            at = filled.find(digest)
            if at < 0 and step > 0:
                at, _ = filled.insert(digest)
                if at == len(live):
                    live.append(0)
                live[at] = 0
            if at >= 0:
                live[at] += step
                if live[at] <= 0:
                    filled.delete(digest)
        rows = [(k, n) for k, n in zip(filled.keys, live) if k is not None]
        return pd.DataFrame(rows, columns=["digest", "live"]).astype({"live": np.int64})

    left = index.withColumn("_b", _bucket("digest", buckets)).groupBy("_b")
    right = summed.withColumn("_b", _bucket("digest", buckets)).groupBy("_b")
    return left.cogroup(right).applyInPandas(apply, "digest binary, live long")
