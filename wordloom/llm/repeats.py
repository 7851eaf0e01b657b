"""Removal of repeated byte strings, found in suffix arrays of anchored pieces.

A string of LENGTH bytes is named by its anchor: the gram of GRAM bytes in it
with the smallest hash.  Equal strings have equal anchors at equal places, so
only places under anchors that occur twice can repeat.  Neighbouring starts
with one anchor form a piece; pieces with equal anchors meet in one task.
There they are laid over each other along the anchor, columns in which all of
a group agree are left out, and a suffix array of what is left tells for each
start whether its string is found elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import whole, written
from wordloom.llm.shingles import mixed
from wordloom.llm.suffixes import longest_repeats

LENGTH = 200
GRAM = 64
SPAN = LENGTH - GRAM + 1  # grams of a string, and the most starts of a piece
WIDTH = LENGTH + SPAN - 1
# Bytes looked at together, and rows of pieces laid out together.
BLOCK = 1 << 20
LAYOUT = 4096
# From so many occurrences of an anchor on, each start is a piece of its own and counted by its hash.
FREQUENT = 20_000
_BITS = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        _powers[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
    return _powers[name][:n]


def _pieces(data: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor's place, anchor's hash) of the pieces of a block.

    ``last`` tells for each place whether LENGTH bytes from there lie in one text.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    starts = np.flatnonzero(last)
    if n < LENGTH or not len(starts):
        return none, none, none, none
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n), dtype=np.uint64)])
    h = mixed((sums[GRAM:] - sums[:-GRAM]) * _power("down", _INVERSE, n - GRAM + 1))
    m = len(h)
    key = np.full(-(-m // SPAN) * SPAN, np.iinfo(np.uint64).max, np.uint64)
    key[:m] = (h & ~_BITS) | np.arange(m, dtype=np.uint64)
    rows = key.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[starts], ahead[starts + SPAN - 1])
    anchor = (least & _BITS).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], new])
    final = np.concatenate([new - 1, [len(starts) - 1]])
    return starts[first], starts[final], anchor[first], h[anchor[first]].view(np.int64)


def pieces_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: (text's number, first start, last start, anchor's place, anchor's hash)."""
    held: list[tuple[int, int, bytes]] = []  # number, offset, bytes
    size = 0

    def out():
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        sizes = np.array([len(x) for _, _, x in held])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        last = np.zeros(len(data), bool)
        for b, k in zip(begins, sizes):
            last[b : b + max(0, k - LENGTH + 1)] = True
        lo, hi, anchor, h = _pieces(data, last)
        which = np.searchsorted(begins, lo, side="right") - 1
        shift = np.array([o for _, o, _ in held], np.int64)[which] - begins[which]
        return np.array([i for i, _, _ in held], np.int64)[which], lo + shift, hi + shift, anchor + shift, h

    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        # A text larger than a block is cut so that each start lies in one part.
        for offset in range(0, len(text) - LENGTH + 1, BLOCK):
            held.append((i, offset, text[offset : offset + BLOCK + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= BLOCK:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _neighbours(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row how many leading columns it shares with another row of its group, at most."""
    keyed = np.hstack([group.astype(">u4").view(np.uint8).reshape(-1, 4), rows.astype(np.uint8)])
    order = np.argsort(np.ascontiguousarray(keyed).view(f"V{keyed.shape[1]}").ravel(), kind="stable")
    a = rows[order]
    differ = np.hstack([a[1:] != a[:-1], np.ones((len(a) - 1, 1), bool)])
    common = np.where(group[order][1:] == group[order][:-1], differ.argmax(1), 0)
    best = np.maximum(np.concatenate([[0], common]), np.concatenate([common, [0]]))
    out = np.empty(len(rows), np.int64)
    out[order] = best
    return out


def repeated(group: np.ndarray, offset: np.ndarray, count: np.ndarray, content: list[bytes]) -> list[np.ndarray]:
    """For each piece a mask of its starts whose strings another piece of its group has.

    ``group`` is ascending, ``offset`` is the anchor's distance from the first
    start, ``count`` the number of starts.  Pieces of a group differ.
    """
    n, centre = len(content), SPAN - 1
    m = np.zeros((n, WIDTH), np.uint8)
    there = np.zeros((n, WIDTH), bool)
    for i, x in enumerate(content):
        lo = centre - offset[i]
        m[i, lo : lo + len(x)] = np.frombuffer(x, np.uint8)
        there[i, lo : lo + len(x)] = True
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    number = np.cumsum(np.concatenate([[False], group[1:] != group[:-1]]))
    odd = (m != m[first[number]]) | ~there
    vary = np.logical_or.reduceat(odd, first, axis=0)
    # How far each piece agrees with any other from the anchor on; nothing beyond can be shared.
    right = centre + _neighbours(m[:, centre:], number)
    left = centre - _neighbours(m[:, :centre][:, ::-1], number)
    column = np.arange(WIDTH)[None, :]
    kept = vary[number] & there & (column >= left[:, None] - 1) & (column <= right[:, None])
    row, col = np.nonzero(kept)
    symbol = (number[row] * WIDTH + col) * 256 + m[row, col]
    _, symbol = np.unique(symbol, return_inverse=True)
    # A sign of its own ends each row.
    size = kept.sum(1)
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    string = np.empty(int(size.sum()) + n, np.int64)
    string[np.arange(len(symbol)) + row] = symbol + n
    string[begin + size] = np.arange(n)
    longest = longest_repeats(string.tolist())
    inside = np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(kept, axis=1)], axis=1)
    out = []
    for i in range(n):
        lo = centre - offset[i] + np.arange(count[i])
        fits = (lo >= left[i]) & (lo + LENGTH <= right[i])
        place = inside[i, lo]
        needed = inside[i, lo + LENGTH] - place
        out.append(fits & (longest[begin[i] + place] >= needed))
    return out


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def _cut(data: bytes, first: int, last: int, anchor: int, frequent: bool) -> list[tuple[int, int, bytes]]:
    """(first start, starts, bytes) of a piece, or of each start if its anchor is frequent."""
    if not frequent:
        return [(first, last - first + 1, data[first : last + LENGTH])]
    return [(s, 1, data[s : s + LENGTH]) for s in range(first, last + 1)]


def _digest(x: bytes, offset: int) -> bytes:
    return xxhash.xxh3_128_digest(x, seed=offset)


def spans(docs: DataFrame) -> DataFrame:
    """``t1, t2`` (hashes of a text) and ``removed``, the starts of repeated strings as runs, for texts with any."""
    text = whole("text").cast("binary")
    keyed = docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(11), text, F.octet_length(text)).alias("t2"), text.alias("text"))

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, _, _, _, h in pieces_of(list(b.text)):
                yield pd.DataFrame({"a": h})

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t1, t2 = b.t1.to_numpy(), b.t2.to_numpy()
            for which, lo, hi, at, h in pieces_of(list(b.text)):
                yield pd.DataFrame({"a": h, "t1": t1[which], "t2": t2[which], "lo": lo, "n": (hi - lo).astype(np.int16), "d": (at - lo).astype(np.int16)})

    often = keyed.select("text").mapInPandas(anchors, "a long").groupBy("a").agg(F.count("*").alias("c")).where("c > 1")
    often = often.select("a", (F.col("c") >= FREQUENT).alias("frequent"))
    hit = keyed.mapInPandas(places, "a long, t1 long, t2 long, lo long, n short, d short").join(often, "a")
    hits = hit.groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "n", "d", "a", "frequent")).alias("hits"))  # one text's
    # Texts under suspicion, once each with the number of rows that have them.
    held = keyed.join(hits, ["t1", "t2"])
    held = written(held.groupBy("t1", "t2").agg(F.first("text").alias("text"), F.first("hits").alias("hits"), F.count("*").alias("copies")))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            met: dict[tuple, list] = {}
            for data, hits, copies in zip(b.text, b.hits, b.copies):
                for x in hits:
                    for s, n, piece in _cut(data, x["lo"], x["lo"] + x["n"], x["lo"] + x["d"], x["frequent"]):
                        offset = x["lo"] + x["d"] - s
                        digest = _digest(piece, offset)
                        g = int.from_bytes(digest[:8], "big", signed=True) if x["frequent"] else x["a"]
                        got = met.get((g, digest))
                        if got:
                            got[-1] += copies
                        else:
                            met[g, digest] = [offset, n, b"" if x["frequent"] else piece, copies]
            if met:
                yield pd.DataFrame([(g, d, *v) for (g, d), v in met.items()], columns=["g", "digest", "offset", "n", "piece", "copies"])

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by g and digest."""
        layout: list[tuple] = []
        current: list[list] = []

        def settle(group: list[list]):
            # A piece with two occurrences is repeated as a whole; alone in its group, others are not.
            done = [(r[0], r[1], [(0, r[3] - 1)]) for r in group if r[5] > 1]
            if len(group) > 1 and len(done) < len(group):
                layout.extend(map(tuple, group))
            return done

        def solved():
            masks = repeated(np.array([r[0] for r in layout]), np.array([r[2] for r in layout]), np.array([r[3] for r in layout]), [r[4] for r in layout])
            return [(r[0], r[1], runs) for r, k in zip(layout, masks) if r[5] == 1 and (runs := _runs(k))]

        def frame(rows):
            return pd.DataFrame({"g": [r[0] for r in rows], "digest": [r[1] for r in rows], "runs": [[{"lo": a, "hi": z} for a, z in r[2]] for r in rows]})

        for b in batches:
            rows = []
            for r in b.itertuples(index=False, name=None):
                if current and current[-1][0] == r[0] and current[-1][1] == r[1]:
                    current[-1][5] += r[5]
                    continue
                if current and current[-1][0] != r[0]:
                    rows += settle(current)
                    current = []
                    if len(layout) >= LAYOUT:
                        rows += solved()
                        layout.clear()
                current.append(list(r))
            if rows:
                yield frame(rows)
        rows = settle(current) if current else []
        if layout:
            rows += solved()
        if rows:
            yield frame(rows)

    def owners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t1, t2, data, hits in zip(b.t1, b.t2, b.text, b.hits):
                for x in hits:
                    for s, n, piece in _cut(data, x["lo"], x["lo"] + x["n"], x["lo"] + x["d"], x["frequent"]):
                        digest = _digest(piece, x["lo"] + x["d"] - s)
                        rows.append((int.from_bytes(digest[:8], "big", signed=True) if x["frequent"] else x["a"], digest, t1, t2, s))
            yield pd.DataFrame(rows, columns=["g", "digest", "t1", "t2", "s"])

    met = held.select("text", "hits", "copies").mapInPandas(emit, "g long, digest binary, offset int, n int, piece binary, copies long")
    dealt = met.repartition("g").sortWithinPartitions("g", "digest")
    flagged = dealt.mapInPandas(resolve, "g long, digest binary, runs array<struct<lo:int,hi:int>>")
    own = held.select("t1", "t2", "text", "hits").mapInPandas(owners, "g long, digest binary, t1 long, t2 long, s long")
    starts = own.join(flagged, ["g", "digest"]).select("t1", "t2", F.explode("runs").alias("r"), "s")
    runs = starts.groupBy("t1", "t2").agg(F.collect_list(F.struct((F.col("s") + F.col("r.lo")).alias("lo"), (F.col("s") + F.col("r.hi")).alias("hi"))).alias("runs"))
    return held.select("t1", "t2", "text").join(runs, ["t1", "t2"])


def _removed(data: bytes, runs) -> tuple[int, int, bytes]:
    """(bytes removed, spans, what stays) if LENGTH bytes go from each start of the runs."""
    parts, at, spans, gone, end = [], 0, 0, 0, -1
    for lo, hi in sorted((r["lo"], r["hi"] + LENGTH) for r in runs):
        if lo > end:
            parts.append(data[at:lo])
            spans += 1
            gone += hi - lo
            at = end = hi
        elif hi > end:
            gone += hi - end
            at = end = hi
    return gone, spans, b"".join([*parts, data[at:]])


def remove(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary, null if the text stays whole).

    Each byte under a string of LENGTH bytes that also starts elsewhere, in
    any row or the same one, is removed; strings are judged on the input and
    may overlap.  Touching runs count as one span.  A null text is empty;
    repeated rows are occurrences, so both lose all bytes; texts shorter than
    LENGTH stay as they are.
    """

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, runs in batches:
            yield pd.DataFrame([_removed(t, r) for t, r in zip(texts, runs)], columns=["n_removed", "n_spans", "kept"])

    found = written(spans(docs).select("t1", "t2", cut("text", "runs").alias("x")))
    text = whole("text").cast("binary")
    rows = docs.select(
        "doc_id", F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(11), text, F.octet_length(text)).alias("t2"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("_whole"),
    )
    return rows.join(found, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("x.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("x.n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.sha2("x.kept", 256), "_whole").alias("kept_sha256"), F.col("x.kept").alias("kept"),
    )
