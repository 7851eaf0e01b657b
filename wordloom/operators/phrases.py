"""Phrase frequencies from the positions of terms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("phrase_id", "field", "doc_id")


def phrase_candidates(postings: DataFrame, phrase_terms: DataFrame, few: bool) -> DataFrame:
    """Documents that hold every term of a phrase, with all positions.

    ``phrase_terms``: ``phrase_id, field, term, bucket, idx, shift, n_terms,
    slop, rarest``; a term at ``shift`` in the phrase has to stand at ``shift``
    after its start.  Only documents of the rarest term can match, so the
    frequent terms are cut down to those, if they are ``few``, before anything
    is shuffled.  Else ``postings`` are best dealt by document already: each
    travels once, and the groups are made where it lies.  A group is one
    document, so its size is bounded by that document; positions travel as
    arrays and are not exploded before the shuffle.
    """
    rows = (
        postings.select("field", "term", "doc_id", "dl_q", "positions", "bucket")
        .join(F.broadcast(phrase_terms), ["field", "term", "bucket"])
        .select(*KEYS, "dl_q", "n_terms", "slop", "idx", "shift", "term", "positions", "rarest")
    )
    if few:
        rare = rows.where("rarest")
        others = rows.where("not rarest").join(F.broadcast(rare.select(*KEYS)), list(KEYS), "left_semi")
        rows = rare.unionByName(others)
    return (
        rows.groupBy(*KEYS)
        .agg(
            F.first("dl_q").alias("dl_q"),
            F.first("n_terms").alias("n_terms"),
            F.first("slop").alias("slop"),
            F.collect_list(F.struct("idx", "shift", "term", "positions")).alias("found"),
        )
        .where(F.size("found") == F.col("n_terms"))
    )


def _starts(found: Column) -> Column:
    return F.transform(found["positions"], lambda p: p - found["shift"])


def exact_frequency(candidates: DataFrame) -> DataFrame:
    """Number of starts common to all terms; ``freq`` above 0 only."""
    found = F.col("found")
    common = F.aggregate(
        F.slice(found, F.lit(2), F.size(found)),
        _starts(F.get(found, F.lit(0))),
        lambda starts, t: F.array_intersect(starts, _starts(t)),
    )
    return (
        candidates.withColumn("freq", F.size(common).cast("double"))
        .where("freq > 0")
        .select(*KEYS, "dl_q", "freq")
    )


def sloppy_frequency(candidates: DataFrame, max_terms: int) -> DataFrame:
    """Sum of 1 / (1 + distance) over the tightest windows within the slop.

    Shift every position back by its place in the phrase; a perfect match is
    then a set of equal numbers.  Walk over the shifted positions in order.
    Where several in a row belong to the same term, only the last counts.  Its
    window reaches to the farthest of the next positions of the other terms,
    the distance is the width of that window, and where a term has no next
    position the walk is over.
    """
    points = candidates.select(*KEYS, "dl_q", "n_terms", "slop", F.explode("found").alias("t")).select(
        *KEYS,
        "dl_q",
        "n_terms",
        "slop",
        F.col("t.idx").alias("idx"),
        F.explode(_starts(F.col("t"))).alias("x"),
    )
    ordered = _walk_order(points)

    # Backwards, so that "the next position of term j" is a running last value.
    backwards = Window.partitionBy(*KEYS).orderBy(F.desc("x"), F.desc("turn"))
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    nexts = [
        F.when(
            F.col("idx") != j,
            F.last(F.when(F.col("idx") == j, F.col("x")), ignorenulls=True).over(later),
        )
        for j in range(max_terms)
    ]
    distance = F.array_max("nexts") - F.col("x")
    counted = (
        (F.size("nexts") == F.col("n_terms") - 1)
        & (F.col("next_idx").isNull() | (F.col("next_idx") != F.col("idx")))
        & (distance <= F.col("slop"))
    )
    return (
        ordered.withColumn("next_idx", F.lag("idx").over(backwards))
        .withColumn("nexts", F.array_compact(F.array(*nexts)))
        .where(counted)
        .groupBy(*KEYS)
        .agg(F.first("dl_q").alias("dl_q"), F.sum(1 / (1 + distance)).alias("freq"))
    )


def apart(starts: list, terms: list, slop: int) -> float:
    """What ``sloppy_frequency`` sums, with no position serving two places.

    ``starts[j]`` are the shifted positions of place j in order, ``terms[j]``
    its term.  Places of one term share their positions, so they meet exactly
    where they have come equally far; the one with the smaller shifted
    position, or else the earlier one, then moves on.  The m-th place of a
    term begins at its m-th position.  A window ends when the last place has
    passed the one that was next when its turn came.
    """
    places = range(len(starts))
    twins = [[k for k in places if k != j and terms[k] == terms[j]] for j in places]
    at = [sum(k < j for k in twins[j]) for j in places]
    if any(at[j] >= len(starts[j]) for j in places):
        return 0.0
    freq, far = 0.0, max(starts[j][at[j]] for j in places)

    def key(j: int) -> tuple[int, int]:
        return starts[j][at[j]], j

    while True:
        last, following = sorted(places, key=key)[:2]
        turn = key(following)[0]
        width = far - key(last)[0]
        while key(last)[0] <= turn:
            width = min(width, far - key(last)[0])
            moving = last
            while moving is not None:
                at[moving] += 1
                if at[moving] == len(starts[moving]):
                    return freq + (1 / (1 + width) if width <= slop else 0.0)
                far = max(far, key(moving)[0])
                met = [k for k in twins[moving] if at[k] == at[moving]]
                moving = min(moving, met[0], key=key) if met else None
        if width <= slop:
            freq += 1 / (1 + width)


def repeated_frequency(candidates: DataFrame) -> DataFrame:
    """``sloppy_frequency`` for phrases that hold a term more than once.

    Whether two places may stand where they do depends on the whole walk
    before, so it is made here document by document in an Arrow function, over
    the positions of the candidates only.
    """

    @F.pandas_udf("double")
    def walk(idx: pd.Series, shift: pd.Series, term: pd.Series, positions: pd.Series, slop: pd.Series) -> pd.Series:
        freqs = []
        for of, shifts, terms, held, n in zip(idx, shift, term, positions, slop):
            order = sorted(range(len(of)), key=lambda i: of[i])
            starts = [[int(p) - int(shifts[i]) for p in held[i]] for i in order]
            freqs.append(apart(starts, [terms[i] for i in order], n))
        return pd.Series(freqs, dtype="float64")

    freq = walk("found.idx", "found.shift", "found.term", "found.positions", "slop")
    return candidates.withColumn("freq", freq).where("freq > 0").select(*KEYS, "dl_q", "freq")


def _walk_order(points: DataFrame) -> DataFrame:
    """Add ``turn``, the order of terms that share a shifted position.

    The term whose turn it was just before goes first, the others follow in
    phrase order.  So the last term of a place is its highest, or the second
    highest if the highest had the turn when the place was reached.  Which of
    the two depends on the place before: it is the same choice again, the
    opposite one, or free of it.  Counting the opposites since the last free
    place settles it without walking.
    """
    by_x = Window.partitionBy(*KEYS).orderBy("x")
    places = (
        points.groupBy(*KEYS, "x")
        .agg(
            F.first("dl_q").alias("dl_q"),
            F.first("n_terms").alias("n_terms"),
            F.first("slop").alias("slop"),
            F.sort_array(F.collect_list("idx"), asc=False).alias("here"),
        )
        .withColumns({"high": F.get("here", F.lit(0)), "second": F.get("here", F.lit(1))})
    )

    def meets(earlier: str) -> Column:
        same = F.lag(earlier).over(by_x) == F.col("high")
        return F.coalesce((F.size("here") > 1) & same, F.lit(False))

    return (
        places.withColumns({"opposite": meets("high"), "same": meets("second")})
        .withColumn("opposites", F.sum(F.col("opposite").cast("int")).over(by_x))
        .withColumn(
            "before",
            F.last(
                F.when(~F.col("opposite") & ~F.col("same"), F.col("opposites")), ignorenulls=True
            ).over(by_x),
        )
        .withColumn(
            "final",
            F.when((F.col("opposites") - F.coalesce("before", F.lit(0))) % 2 == 1, F.col("second")).otherwise(
                F.col("high")
            ),
        )
        .withColumn("turn_at", F.lag("final").over(by_x))
        .select(*KEYS, "dl_q", "n_terms", "slop", "x", "turn_at", F.explode("here").alias("idx"))
        .withColumn("turn", F.when(F.col("idx") == F.col("turn_at"), -1).otherwise(F.col("idx")))
    )
