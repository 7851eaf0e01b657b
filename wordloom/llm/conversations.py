"""Conversation repair: divide and conquer over cost vectors of four states, in linear space."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import written

DELETE, INSERT, REROLE, TRUNCATED_STAYS = 2, 5, 1, 5
KINDS = "sua"  # role initials that a repaired conversation can have; any other is kind 3
WHOLE, BLANK, DUPLICATE, TRUNCATED = range(4)

# What stands so far of (s?(ua)+)?: nothing, s, .. u, .. a.  An insert or a new role goes to NEXT.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})

FAR = 1 << 40
# Bits of a row number that a stretch, and each level of stretches above it, leaves out.
SHIFT = 8
_LEAVES = 1 << 15
_PIECE = 1 << 13


def _moves(kind: int, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, after) to the cheapest, then ASCII-least, inserts and edit of one row.

    Two inserts in a row at most: a third comes back to a state it was in.
    """
    out: dict[tuple[int, int], tuple[int, str]] = {}
    stays = TRUNCATED_STAYS if fault == TRUNCATED else 0
    for before in range(4):
        state = before
        for inserts in range(3):
            edits = [("D", state, DELETE)]
            if fault not in (BLANK, DUPLICATE):
                edits.append(("R", NEXT[state], REROLE + stays))
                if state in KEEP[kind]:
                    edits.append(("K", KEEP[kind][state], stays))
            for letter, after, price in edits:
                offer = (inserts * INSERT + price, "I" * inserts + letter)
                out[before, after] = min(out.get((before, after), offer), offer)
            state = NEXT[state]
    return out


def _tables():
    """Costs and ranks (16, 4, 4) by code of a row, and what each move writes."""
    cost, rank = np.full((16, 4, 4), FAR, np.int64), np.zeros((16, 4, 4), np.int64)
    letters, leads, roles = [""] * 256, [""] * 256, [None] * 256
    for code in range(16):
        moves = _moves(code // 4, code % 4)
        for before in range(4):
            order = sorted(range(4), key=lambda after: moves.get((before, after), (0, "~"))[1])
            for place, after in enumerate(order):
                rank[code, before, after] = place
                if (before, after) not in moves:
                    continue
                cost[code, before, after], edit = moves[before, after]
                at, state, lead = code * 16 + before * 4 + after, before, []
                for _ in edit[:-1]:
                    state = NEXT[state]
                    lead.append(f"{ROLE[state]}:")
                letters[at], leads[at] = edit, "\n".join(lead)
                roles[at] = {"D": None, "K": "", "R": ROLE[NEXT[state]]}[edit[-1]]
    return cost, rank, letters, leads, roles


_COST, _RANK, _LETTERS, _LEADS, _ROLES = _tables()


def _after(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Costs and ranks (n, 4, 4) of stretches a followed by stretches b.

    A cost is that of the best audit from a state to a state.  The rank orders
    the best audits from one state by ASCII: each ends with the edit of a last
    row and none begins another, so the first parts decide, then the second.
    """
    total = a[0][:, :, :, None] + b[0][:, None, :, :]
    cross = (total * 4 + a[1][:, :, :, None]).argmin(2)[:, :, None, :]
    cost = np.minimum(np.take_along_axis(total, cross, 2)[:, :, 0], FAR)
    order = a[1][:, :, :, None] * 4 + b[1][:, None, :, :]
    order = np.take_along_axis(order, cross, 2)[:, :, 0]
    return cost, (order[:, :, :, None] > order[:, :, None, :]).sum(3)


def _children(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sequences halved by pairs: their new sizes, the left child of each pair, whether there is a right one."""
    halves = (sizes + 1) // 2
    first = np.repeat(np.cumsum(sizes) - sizes, halves)
    nth = np.arange(halves.sum()) - np.repeat(np.cumsum(halves) - halves, halves)
    return halves, first + 2 * nth, 2 * nth + 1 < np.repeat(sizes, halves)


def climb(cost: np.ndarray, rank: np.ndarray, sizes: np.ndarray) -> list:
    """Levels of joined neighbours, up to one node a sequence; all levels together have twice the leaves."""
    levels = [(cost, rank, sizes)]
    while sizes.max(initial=0) > 1:
        halves, left, two = _children(sizes)
        new_cost, new_rank = cost[left], rank[left]
        new_cost[two], new_rank[two] = _after((cost[left[two]], rank[left[two]]), (cost[left[two] + 1], rank[left[two] + 1]))
        cost, rank, sizes = new_cost, new_rank, halves
        levels.append((cost, rank, sizes))
    return levels


def descend(levels: list, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States before and after each leaf on the audit-least cheapest way from ``start`` to ``end`` of its sequence.

    Where two halves meet, the forward vector of the first and the backward
    vector of the second give the cheapest crossings; of those the one that the
    audit-least first half leads to is taken, and both halves go on alone.
    """
    for cost, rank, sizes in reversed(levels[:-1]):
        _, left, two = _children(sizes)
        before, after = np.empty(len(cost), np.int64), np.empty(len(cost), np.int64)
        before[left], after[left] = start, end
        i, p, s = left[two], start[two], end[two]
        cross = ((cost[i, p] + cost[i + 1, :, s]) * 4 + rank[i, p]).argmin(1)
        after[i], before[i + 1], after[i + 1] = cross, cross, s
        start, end = before, after
    return start, end


def _parts(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of sequences of about _LEAVES leaves together."""
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(np.cumsum(lengths[at:]), _LEAVES, "right")) + at)
        yield at, to
        at = to


def _codes(texts) -> np.ndarray:
    digits = np.frombuffer("".join(texts).encode("ascii"), np.uint8)
    return np.where(digits > 57, digits - 87, digits - 48).astype(np.int64)


def _illegal(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the row before, in the same sequence, has a role that this one's may not follow."""
    kind = codes // 4
    was = np.concatenate([[3], kind[:-1]])
    legal = ((kind == 1) & ((was == 0) | (was == 2))) | ((kind == 2) & (was == 1))
    return ~legal & ~first


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        lengths = batch.codes.str.len().to_numpy(np.int64)
        for a, b in _parts(lengths):
            part, sizes = batch.iloc[a:b], lengths[a:b]
            codes = _codes(part.codes)
            starts = np.cumsum(sizes) - sizes
            first = np.zeros(len(codes), bool)
            first[starts] = True
            cost, rank, _ = climb(_COST[codes], _RANK[codes], sizes)[-1]
            yield pd.DataFrame({
                "conv": part.conv.values, "id": part.id.values, "codes": part.codes.values, "cost": list(cost.reshape(-1, 16)), "rank": list(rank.reshape(-1, 16)),
                "illegal": np.add.reduceat(_illegal(codes, first).astype(np.int64), starts), "head": codes[starts] // 4, "tail": codes[starts + sizes - 1] // 4,
            })


def _nested(children: pd.Series, name: str) -> np.ndarray:
    return np.array([c[name] for row in children for c in row], np.int64)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Up to 2**SHIFT neighbouring stretches as one."""
    for batch in batches:
        lengths = batch.children.str.len().to_numpy(np.int64)
        for a, b in _parts(lengths):
            part, sizes = batch.iloc[a:b], lengths[a:b]
            cost, rank = (_nested(part.children, c).reshape(-1, 4, 4) for c in ("cost", "rank"))
            head, tail, inside = (_nested(part.children, c) for c in ("head", "tail", "illegal"))
            starts = np.cumsum(sizes) - sizes
            was = np.concatenate([[3], tail[:-1]])
            seam = ~(((head == 1) & ((was == 0) | (was == 2))) | ((head == 2) & (was == 1)))
            seam[starts] = False
            cost, rank, _ = climb(cost, rank, sizes)[-1]
            yield pd.DataFrame({
                "conv": part.conv.values, "id": part.id.values, "cost": list(cost.reshape(-1, 16)), "rank": list(rank.reshape(-1, 16)),
                "illegal": np.add.reduceat(inside + seam, starts), "head": head[starts], "tail": tail[starts + sizes - 1],
            })


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The states at the ends of a stretch, for each stretch below it."""
    for batch in batches:
        lengths = batch.children.str.len().to_numpy(np.int64)
        for a, b in _parts(lengths):
            part, sizes = batch.iloc[a:b], lengths[a:b]
            cost, rank = (_nested(part.children, c).reshape(-1, 4, 4) for c in ("cost", "rank"))
            start, end = descend(climb(cost, rank, sizes), part.start.to_numpy(np.int64), part.end.to_numpy(np.int64))
            yield pd.DataFrame({"conv": np.repeat(part.conv.values, sizes), "id": _nested(part.children, "id"), "start": start, "end": end})


def _write_audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        lengths = batch.codes.str.len().to_numpy(np.int64)
        for a, b in _parts(lengths):
            part, sizes = batch.iloc[a:b], lengths[a:b]
            codes = _codes(part.codes)
            start, end = descend(climb(_COST[codes], _RANK[codes], sizes), part.start.to_numpy(np.int64), part.end.to_numpy(np.int64))
            moves = np.split(codes * 16 + start * 4 + end, np.cumsum(sizes)[:-1])
            audits = ["".join(_LETTERS[m] for m in each) for each in moves]
            yield pd.DataFrame({"conv": part.conv.values, "id": part.id.values, "audit": audits, "moves": moves})


_SUMMARY = "cost array<bigint>, rank array<bigint>, illegal bigint, head bigint, tail bigint"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` with the faults that the benchmark of this operator asks for.

    By ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its text, 2 takes
    out its ``.!?``, 3 writes it twice, 4 makes its role user.  Null ids and
    turns count as one space there, null roles and texts become one.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    by = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(by == 1, F.lit("")).when(by == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    copies = F.when(by == 0, 0).when(by == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", F.when(by == 4, F.lit("user")).otherwise(text_of("role")).alias("role"), text.alias("text"), F.array_repeat(F.lit(0), copies).alias("_each"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("_each")).drop("col")


def _conv(conv_id: str = "conv_id") -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("null"))


@dataclass
class Repair:
    """``conversations``: a row each with the counts of its faults, cost and audit.
    ``lines``: ``conv_id, at, line`` of the repaired ones, ``role:text`` by ascending ``at`` (a line may hold several, newline between)."""

    conversations: DataFrame
    lines: DataFrame


def repair(rows: DataFrame) -> Repair:
    """The cheapest edits that give each conversation role initials ``(s?(ua)+)?``.

    Rows ``conv_id, turn, role, text`` are taken by turn, nulls first; of equal
    turns by role, then text.  Null roles and texts count as one space.  The
    first of these faults counts for a row: blank (only white space), duplicate
    (role and text stood earlier in the conversation), truncated (the last
    character that is no white space is none of ``.!?``).  Keep costs 0, Rerole
    to user or assistant 1, Delete 2 (blank and duplicate rows must go), Insert
    of an empty text by user or assistant 5, and a truncated row that stays 5
    more; of equally cheap audits the ASCII-least.  A null conv_id is a
    conversation of its own, other columns are left out, no rows give no rows.

    A range partitioning by conversation and order numbers all rows, so one
    conversation may fill many partitions.  Stretches of 2**SHIFT row numbers
    are reduced to 16 costs and ranks, neighbouring stretches to one again,
    until a conversation is one; then the crossings are chosen from the top
    down.  Nothing of a conversation meets in one task but its audit, which is
    one value of the result.
    """
    spark = rows.sparkSession
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = rows.select("conv_id", _conv().alias("conv"), "turn", space("role").alias("role"), space("text").alias("text"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    tied = F.monotonically_increasing_id().alias("_tied")  # equal rows may fill more than one partition
    cut = rows.select("*", tied).repartitionByRange(*order, "_tied").sortWithinPartitions(*order, "_tied")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(WHOLE)
    first_char = F.substring("role", 1, 1)
    kind = F.when(first_char == "s", 0).when(first_char == "u", 1).when(first_char == "a", 2).otherwise(3)
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    cut = cut.withColumn("at", F.monotonically_increasing_id()).drop("_tied")
    cut = written(cut.withColumns({"fault": fault, "kind": kind, "same": F.when(fault != BLANK, same)}))

    repeated = cut.where(f"fault <> {BLANK}").groupBy("conv", "same").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    told = cut.select("conv", "at", "turn", "fault", "kind", "same").join(repeated, ["conv", "same"], "left")
    told = told.withColumn("fault", F.when(F.col("at") > F.col("first"), DUPLICATE).otherwise(F.col("fault")))
    digit = F.lower(F.hex(F.col("kind") * 4 + F.col("fault")))
    told = told.select("conv", "at", "turn", "fault", digit.alias("code"))

    pairs = F.sort_array(F.collect_list(F.struct("at", "code")))
    counts = [F.count_if(F.col("fault") == f).alias(name) for f, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))]
    stretches = written(
        told.groupBy("conv", F.shiftright("at", SHIFT).alias("id"))
        .agg(pairs.alias("pairs"), *counts)
        .select("conv", "id", F.array_join("pairs.code", "").alias("codes"), "pairs.at", "blank", "duplicate", "truncated")
    )
    told = stretches.select("conv", "id", "codes").mapInPandas(_summarise, f"conv string, id bigint, codes string, {_SUMMARY}")
    level = leaves = written(told)

    # Up: conversations of one stretch are done, the others' neighbours are joined.
    tops, parents = [], []
    while True:
        alone = level.groupBy("conv").agg(F.count("*").alias("n"))
        tops.append(level.join(alone.where("n = 1").select("conv"), "conv").select("conv", "id", "cost", "rank", "illegal", F.lit(len(parents)).alias("level")))
        rest = level.join(alone.where("n > 1").select("conv"), "conv")
        child = F.struct("id", "cost", "rank", "illegal", "head", "tail")
        rest = written(rest.groupBy("conv", F.shiftright("id", SHIFT).alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("children")))
        rest = rest.select("conv", F.col("parent").alias("id"), "children")
        if rest.isEmpty():
            break
        parents.append(rest)
        level = written(rest.mapInPandas(_merge, f"conv string, id bigint, {_SUMMARY}"))
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    # The end of each: what costs least with the inserts that complete it.
    ends = [(0, 0), (1, 2), (2, 1), (3, 0)]
    offers = [F.struct((F.get("cost", F.lit(s)) + INSERT * n).alias("cost"), F.get("rank", F.lit(s)).alias("rank"), F.lit(s).alias("end"), F.lit("I" * n).alias("rest")) for s, n in ends]
    top = written(top.withColumn("best", F.array_min(F.array(*offers))).select("conv", "id", "level", "illegal", "best.cost", "best.end", "best.rest"))

    # Down: each stretch learns the states at its ends.
    ways = None
    for n in range(len(parents), -1, -1):
        here = top.where(F.col("level") == n).select("conv", "id", F.lit(0).cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
        ways = here if ways is None else ways.unionByName(here)
        if n:
            below = parents[n - 1].join(ways, ["conv", "id"])
            ways = written(below.mapInPandas(_split, "conv string, id bigint, start bigint, end bigint"))
    audited = written(leaves.select("conv", "id", "codes").join(ways, ["conv", "id"]).mapInPandas(_write_audits, "conv string, id bigint, audit string, moves array<bigint>"))

    whole = audited.groupBy("conv").agg(F.array_join(F.sort_array(F.collect_list(F.struct("id", "audit")))["audit"], "").alias("audit"))
    counted = stretches.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    turns = cut.groupBy("conv").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("turns"), F.first("conv_id").alias("conv_id"))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    found = turns.join(counted, "conv").join(whole, "conv").join(top, "conv")
    found = found.select("conv", "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("cost").cast("bigint").alias("cost"), F.concat("audit", "rest").alias("audit"))

    known = spark.createDataFrame([(i, lead, role) for i, (edit, lead, role) in enumerate(zip(_LETTERS, _LEADS, _ROLES)) if edit], "move bigint, lead string, new_role string")
    each = audited.join(stretches.select("conv", "id", "at"), ["conv", "id"]).select(F.explode(F.arrays_zip("at", "moves")).alias("m")).select("m.at", F.col("m.moves").alias("move"))
    each = each.join(F.broadcast(known), "move").where("lead <> '' or new_role is not null")  # of 256 moves
    own = F.concat(F.when(F.col("new_role") == "", F.col("role")).otherwise(F.col("new_role")), F.lit(":"), "text")
    lines = cut.select("conv", "conv_id", "at", "role", "text").join(each, "at").select("conv", "conv_id", "at", F.concat_ws("\n", F.when(F.col("lead") != "", F.col("lead")), own).alias("line"))
    # A conversation that ends after s or u is completed.
    complete = F.when(F.col("end") == 1, F.lit("user:\nassistant:")).when(F.col("end") == 2, F.lit("assistant:"))
    closing = top.where("end in (1, 2)").join(turns.select("conv", "conv_id"), "conv").select("conv", "conv_id", F.lit((1 << 63) - 1).alias("at"), complete.alias("line"))
    return Repair(found, lines.unionByName(closing))


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, at, state = None, None, None
    for batch in batches:
        done = []
        for c, n, piece in zip(batch.conv, batch["at"], batch.piece):
            if c != conv:
                if state is not None:
                    done.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256()
            elif n != at:
                state.update(b"\n")
            at = n
            state.update(piece)
        yield pd.DataFrame(done, columns=["conv", "sha256"])
    if state is not None:
        yield pd.DataFrame([(conv, state.hexdigest())], columns=["conv", "sha256"])


def digests(lines: DataFrame) -> DataFrame:
    """``conv, sha256`` of the lines in their order, newline between.

    A hash runs over a conversation from its start to its end, so one task reads
    each conversation, in pieces of 2**13 bytes from the sorted shuffle; it holds no more than a batch of them.
    """
    data = F.col("line").cast("binary")
    count = F.greatest(F.lit(0), F.ceil(F.octet_length("line") / _PIECE) - 1).cast("int")
    numbered = lines.select("conv", "at", data.alias("data"), F.explode(F.sequence(F.lit(0), count)).alias("k"))
    pieces = numbered.select("conv", "at", "k", F.substring("data", F.col("k") * _PIECE + 1, F.lit(_PIECE)).alias("piece"))
    return pieces.repartition("conv").sortWithinPartitions("conv", "at", "k").mapInPandas(_hash, "conv string, sha256 string")
