"""Benchmark decontamination: size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.shingles import K, mixed, rolled, words

CONTAINMENT = 0.8
HASHES = 64
# Bytes of benchmark text that one pass over the documents carries to its tasks.
BLOCK_BYTES = 4 << 20
STRIDE = 1 << 16
# Shingles, or blocks, whose HASHES values are laid out at a time.
PIECE = 1 << 12

_ODD = (mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_FLIP = (mixed(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_FILTER = 1 << 20


def _values(h: np.ndarray) -> np.ndarray:
    """HASHES x n values whose minima are the sketch."""
    values = (h >> np.uint64(32)).astype(np.uint32)[None, :] ^ _FLIP[:, None]
    values *= _ODD[:, None]
    return values


def _minima(h: np.ndarray, width: int) -> np.ndarray:
    """HASHES minima of each block of ``width`` shingles; the values behind them exist piece by piece."""
    step = max(PIECE, width)
    pieces = (h[i : i + step] for i in range(0, len(h), step))
    return np.hstack([np.minimum.reduceat(_values(p), np.arange(0, len(p), width), axis=1) for p in pieces])


class Sketches:
    """Shingle sets in partitions by size, each with the sketches of its sets.

    A set of q shingles belongs to the smallest width B, a power of two, that
    holds it.  A document is cut into blocks of B shingles, and two neighbouring
    blocks are a segment, so an item that stands in a document lies within one
    segment of at most 4q shingles: a similarity of 0.8 / 4.2 or more for a
    containment of 0.8, whatever the document's length.  With bands of one
    value, HASHES of them miss such a segment with a chance of 0.81 ** 64,
    under 2 in a million; a single shingle is never missed.
    """

    def __init__(self, sets: dict[int, np.ndarray]):
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_width: dict[int, list[int]] = {}
        for i, q in sets.items():
            by_width.setdefault(1 << (len(q) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            sketch = np.stack([_values(sets[i]).min(1) for i in members], axis=1)
            keys = (sketch.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))[:, None]).ravel()
            owner = np.tile(np.array(members), HASHES)
            order = np.argsort(keys, kind="stable")
            near = np.zeros(_FILTER, bool)
            near[self._place(keys)] = True
            self.parts[width] = (keys[order], owner[order], near)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(23))) & np.uint64(_FILTER - 1)).astype(np.int64)

    def candidates(self, h: np.ndarray) -> set[int]:
        """Items of which some segment of the document has a sketch value."""
        found: set[int] = set()
        smallest, widest = min(self.parts), max(self.parts)
        stride = max(STRIDE, 2 * widest)
        row = (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))[:, None]
        for start in range(0, len(h), stride - widest):
            chunk = h[start : start + stride]  # a segment over a chunk's end lies in the next one
            width, low = smallest, _minima(chunk, smallest)
            while True:
                if width in self.parts:
                    keys, owner, near = self.parts[width]
                    # The minimum of two blocks is one of theirs, so testing blocks tests all segments.
                    for at in range(0, low.shape[1], PIECE):
                        seen = low[:, at : at + PIECE] + row
                        seen = seen[near[self._place(seen)]]
                        if len(seen):
                            seen = np.unique(seen)
                            left, right = np.searchsorted(keys, seen, "left"), np.searchsorted(keys, seen, "right")
                            for a, b in zip(left, right):
                                found.update(owner[a:b].tolist())
                if width >= widest:
                    break
                if low.shape[1] > 1:
                    even = low.shape[1] // 2 * 2
                    joined = np.minimum(low[:, 0:even:2], low[:, 1:even:2])
                    low = joined if even == low.shape[1] else np.hstack([joined, low[:, even:]])
                width *= 2
            if start + stride >= len(h):
                break
        return found


class Items:
    """Test items by the number of words in their shingles: K, or all their words if they have fewer."""

    def __init__(self, texts: list[str]):
        found = [words(t) for t in texts]
        self.sets = [np.unique(rolled(w)) for w in found]
        by_words: dict[int, dict[int, np.ndarray]] = {}
        for i, w in enumerate(found):
            if len(w):
                by_words.setdefault(min(K, len(w)), {})[i] = self.sets[i]
        self.sketches = {k: Sketches(sets) for k, sets in by_words.items()}

    def contained(self, text: str | None, least: float) -> list[tuple[int, int, int]]:
        """(item, shared shingles, its shingles) for items that the text contains to that part."""
        w, out = words(text), []
        for k, sketches in self.sketches.items():
            if len(w) < k:
                continue
            h = rolled(w, k)
            found = sketches.candidates(h)
            own = np.unique(h) if found else h
            for i in found:
                q = self.sets[i]
                at = np.minimum(np.searchsorted(own, q), len(own) - 1)
                shared = int((own[at] == q).sum())
                if shared >= least * len(q):
                    out.append((i, shared, len(q)))
        return sorted(out)


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    """Parts of the benchmark that fit a pass each."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-size // BLOCK_BYTES)
    if n <= 1:
        return [items] if size else []
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.where(part == i) for i in range(n)]


def _carried(block: DataFrame) -> tuple[Broadcast, list]:
    """The texts of a block for the tasks, and the ids of its items by their number."""
    rows = sorted(block.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))  # BLOCK_BYTES
    return block.sparkSession.sparkContext.broadcast([r["text"] for r in rows]), [r["item_id"] for r in rows]


def _found(docs: DataFrame, texts: Broadcast, least: float) -> DataFrame:
    """``doc_id, _i, n_shared, n_item`` for the items that the documents contain.

    Rows are made in Python: an array column to be exploded would let Spark put
    a filter before the explode and so search in two workers for each task.
    """
    numbers = pa.schema([("_i", pa.int32()), ("n_shared", pa.int32()), ("n_item", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts.value)
        for batch in batches:
            found = [(n, *m) for n, t in enumerate(batch.column(1)) for m in items.contained(t.as_py(), least)]
            if found:
                at, *rest = map(list, zip(*found))
                columns = [pa.array(c, f.type) for c, f in zip(rest, numbers)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], ["doc_id", *numbers.names])

    narrow = docs.select("doc_id", "text")
    schema = T.StructType([narrow.schema["doc_id"], *(T.StructField(n, T.IntegerType()) for n in numbers.names)])
    return narrow.mapInArrow(search, schema)


def _free_of(docs: DataFrame, texts: Broadcast, least: float) -> DataFrame:
    """The rows of docs that contain none of the items."""

    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(texts.value)
        for batch in batches:
            yield pd.Series([not items.contained(t, least) for t in batch], dtype=bool)

    return docs.where(free("text"))


def matches(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT) -> DataFrame:
    """Pairs ``doc_id, item_id, n_shared, n_item, containment`` with containment of at least ``least``.

    Containment is the part of an item's distinct 5-word shingles that the
    whole document has, by exact comparison of 64-bit shingle hashes after the
    MinHash search.  An item of fewer than five words is one shingle of that
    many words: a document contains it if the words stand there in a row.  Null
    and empty texts on either side match nothing; a repeated benchmark row
    counts once, repeated documents each.  The benchmark is the query set; it
    is carried to the documents in blocks of BLOCK_BYTES, a pass for each.
    """
    out = []
    for block in _blocks(benchmark):
        texts, ids = _carried(block)
        named = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(ids)), f"_i int, item_id {dict(benchmark.dtypes)['item_id']}"))
        rows = _found(docs, texts, least).join(named, "_i")
        out.append(rows.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")))
    if not out:
        return docs.select("doc_id", F.lit(None).cast(dict(benchmark.dtypes)["item_id"]).alias("item_id"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_item"), F.lit(0.0).alias("containment")).where("false")
    union = out[0]
    for more in out[1:]:
        union = union.unionByName(more)
    return union


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT) -> DataFrame:
    """docs without those that contain a test item; all columns and other rows as they are."""
    for block in _blocks(benchmark):
        docs = _free_of(docs, _carried(block)[0], least)
    return docs
