"""R-trees over points of group sums, and what deals points to tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 32
SMALL = 8
_NEEDED = 1 << 22


def groups_of(n: int) -> int:
    """Groups that the tokens of a set of n are hashed into: 128 times a power of 8, n / 8 at least."""
    g = 128
    while g * 8 < n:
        g *= 8
    return g


def unpacked(n: int, data: bytes) -> np.ndarray:
    g = groups_of(n)
    return np.frombuffer(data, f"u{len(data) // g}")


def folded(v: np.ndarray, g: int) -> np.ndarray:
    """Counts in g groups from counts in more."""
    return v if len(v) == g else v.reshape(-1, g).sum(0, dtype=np.uint32)


def stacked(vectors: list[np.ndarray]) -> np.ndarray:
    g = min(map(len, vectors))
    return np.stack([folded(v, g) for v in vectors])


@dataclass(frozen=True)
class Rule:
    """What a link asks for: the least size beside a set of size n, the least overlap of sizes a and b."""

    least: Callable
    overlap: Callable


class Tree:
    """R-tree over points of group counts.

    Points are cut at the median of the coordinate that varies most, down to
    leaves; a node keeps the largest coordinates below it.  The sum of
    coordinate minima of a point and a node bounds the overlap with any set
    below the node, that of two points the overlap of their sets.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rule: Rule):
        self.points, self.sizes, self.rule = points, sizes, rule
        leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            own = todo.pop()
            if len(own) <= LEAF:
                leaves.append(own)
                continue
            axis = points[own].astype(np.float32).var(0).argmax()
            order = own[np.argsort(points[own, axis], kind="stable")]
            todo += [order[len(own) // 2 :], order[: len(own) // 2]]
        self.leaves = leaves
        at = np.concatenate(leaves)
        starts = np.cumsum([0, *map(len, leaves[:-1])])
        level = np.maximum.reduceat(points[at], starts, axis=0), np.maximum.reduceat(sizes[at], starts), np.minimum.reduceat(sizes[at], starts)
        self.levels = [level]
        while len(level[0]) > LEAF:
            starts = np.arange(0, len(level[0]), LEAF)
            level = np.maximum.reduceat(level[0], starts, axis=0), np.maximum.reduceat(level[1], starts), np.minimum.reduceat(level[2], starts)
            self.levels.append(level)

    def near(self, i: int) -> np.ndarray:
        """Points whose bound with point i reaches the overlap of a link, i itself too."""
        point, n, rule = self.points[i], int(self.sizes[i]), self.rule
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, most, least = self.levels[depth]
            fits = (most[nodes] >= rule.least(n)) & (rule.least(least[nodes]) <= n)
            nodes = nodes[fits]
            bound = np.minimum(corner[nodes], point).sum(1, dtype=np.int64)
            nodes = nodes[bound >= rule.overlap(np.maximum(least[nodes], rule.least(n)), n)]
            if depth:
                below = len(self.levels[depth - 1][0])
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < below]
        if not len(nodes):
            return nodes
        at = np.concatenate([self.leaves[k] for k in nodes])
        bound = np.minimum(self.points[at], point).sum(1, dtype=np.int64)
        return at[bound >= rule.overlap(self.sizes[at], n)]


class _Joined:
    """Which points are connected so far."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.members = [[i] for i in range(n)]

    def join(self, i: int, j: int) -> bool:
        a, b = self.of[i], self.of[j]
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.of[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []
        return True


def forest(points: np.ndarray, sizes: np.ndarray, test: Callable[[int, np.ndarray], np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links that connect all points that links connect.

    ``test(i, others)`` tells which of the others, that the tree's bounds let
    through, i links with.  Points that are connected are not tested with each
    other.  The points connected with one chosen point need no search of their
    own: whoever links with them is either among them or searches itself.
    """
    tree, joined, links = Tree(points, sizes, rule), _Joined(len(points)), []
    order = np.random.default_rng(len(points)).permutation(len(points))
    chosen, most = -1, 0
    for turn, i in enumerate(order):
        if chosen >= 0 and joined.of[i] == joined.of[chosen]:
            continue
        others = tree.near(i)
        while True:
            others = others[joined.of[others] != joined.of[i]]
            if not len(others):
                break
            # A few at a time: what the first ones connect need not be tested.
            few, others = others[:LEAF], others[LEAF:]
            for j in few[test(i, few)]:
                if joined.join(i, j):
                    links.append((int(i), int(j)))
        if turn < SMALL and len(joined.members[joined.of[i]]) > most:
            chosen_next, most = i, len(joined.members[joined.of[i]])
        if turn == min(SMALL, len(order)) - 1:
            chosen = chosen_next
    return links


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches, cut so that no key spans two."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        by = batch[keys].to_numpy()
        cuts = np.flatnonzero((by[1:] != by[:-1]).any(1)) + 1
        fresh = held and (held[-1][keys].iloc[-1].to_numpy() != by[0]).any()
        if fresh:
            yield pd.concat(held, ignore_index=True)
            held = []
        if len(cuts):
            yield pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True)
            held = [batch.iloc[cuts[-1] :]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def runs(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    by = frame[keys].to_numpy()
    return np.concatenate([[0], np.flatnonzero((by[1:] != by[:-1]).any(1)) + 1, [len(frame)]])


def paged(rows: DataFrame, keys: list[str], pages) -> DataFrame:
    """Each row once for each pair of pages that its own is in, as ``i, j``."""
    own = F.pmod(F.xxhash64("node"), F.col("pages")).cast("int")
    dealt = rows.withColumn("pages", pages.cast("int")).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", "pages")
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``node, text`` for rows ``node, t1, t2``; flags of a fixed number of hash values leave out most others before the join."""
    slot = F.col("t1").bitwiseAND(F.lit(_NEEDED - 1)).cast("int")
    flags = np.zeros(_NEEDED, bool)
    flags[needed.select(slot.alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True  # _NEEDED rows at most
    flags = docs.sparkSession.sparkContext.broadcast(flags)

    @F.pandas_udf("boolean")
    def asked(t1: pd.Series) -> pd.Series:
        return pd.Series(flags.value[t1.to_numpy(np.int64) & (_NEEDED - 1)])

    keyed = docs.select(*digests(), "text")
    return keyed.where(asked("t1")).join(needed, ["t1", "t2"]).dropDuplicates(["node"]).select("node", "text")


def digests():
    return F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(11), "text", F.octet_length("text")).alias("t2")
