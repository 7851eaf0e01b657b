"""Fuzzy clauses as a table: words joined to the dictionary by what deletions leave of them.

Two words within n edits, a swap of neighbours being one, become equal when at
most n characters are deleted from each.  That also holds for their first
PREFIX characters alone, so a term of any length has a bounded number of keys.
Terms that share a key with a word are then checked by their edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_EDITS = 2
PREFIX = 8


def _without_one(word: Column) -> Column:
    """Every word that a deletion of one character makes; none of an empty word."""
    at = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.left(word, i - 1), F.substr(word, i + 1)))


def deletions(word: Column, edits: int | None = None, prefix: int | None = None) -> Column:
    """The distinct words that up to ``edits`` deletions leave of the first ``prefix`` characters."""
    found = step = F.array(F.left(word, F.lit(PREFIX if prefix is None else prefix)))
    for _ in range(MAX_EDITS if edits is None else edits):
        step = F.array_distinct(F.flatten(F.transform(step, _without_one)))
        found = F.concat(found, step)
    return F.array_distinct(found)


def _keys(word: str) -> Column:
    return F.transform(deletions(F.col(word)), lambda w: F.xxhash64(w))


def _within(a: Column, b: Column, edits: int) -> Column:
    return F.levenshtein(a, b, edits) >= 0


def _swaps(word: Column) -> Column:
    """Where different neighbours stand, counted from 1."""
    at = F.when(F.length(word) > 1, F.sequence(F.lit(1), F.length(word) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, lambda i: F.substr(word, i, F.lit(1)) != F.substr(word, i + 1, F.lit(1)))


def _swapped(word: Column, i: Column) -> tuple[Column, Column, Column]:
    """(before, swapped pair, after)."""
    pair = F.concat(F.substr(word, i + 1, F.lit(1)), F.substr(word, i, F.lit(1)))
    return F.left(word, i - 1), pair, F.substr(word, i + 2)


def _within_one(term: Column, word: Column) -> Column:
    return _within(term, word, 1) | F.exists(_swaps(word), lambda i: F.concat(*_swapped(word, i)) == term)


def edits_between(term: Column, word: Column) -> Column:
    """0, 1 or 2 edits between two columns; null above 2.

    A swap of neighbours is one edit and a swapped pair is not edited again:
    with a swap among two edits, everything on one side of the pair is equal,
    and the other sides are within one edit.
    """

    def around(i: Column) -> Column:
        before, pair, after = _swapped(word, i)
        head, tail = F.concat(before, pair), F.concat(pair, after)
        rest = F.substr(term, F.length(head) + 1)
        start = F.left(term, F.length(term) - F.length(tail))
        return (F.startswith(term, head) & _within_one(rest, after)) | (F.endswith(term, tail) & _within(start, before, 1))

    two = _within(term, word, 2) | F.exists(_swaps(word), around)
    return F.when(term == word, 0).when(_within_one(term, word), 1).when(two, 2)


def expand(dictionary: DataFrame, clauses: DataFrame, few: bool) -> DataFrame:
    """The terms within the edits of each clause.

    ``clauses``: ``clause`` (its identity, any type), ``field, word`` (in lower
    case) and ``max_edits`` (0 to 2); ``dictionary``: ``field, term, bucket,
    df``.  Gives ``clause, field, term, bucket, df, closeness``: ``df`` is the
    largest of the clause's terms in that field, which they share, and
    ``closeness`` is 1 for the word itself, else 1 less the edits over the
    shorter length; terms of closeness 0 are left out, and so are clauses with
    an empty or null word.

    The dictionary is read once for all clauses.  If they are ``few`` their
    keys go to its tasks, which keep what shares a key; beyond, both sides are
    shuffled by the hash of the key.  Nothing is collected.
    """
    asked = clauses.where("word <> '' and max_edits between 0 and 2")
    keyed = asked.select("clause", "field", "word", "max_edits", F.explode(_keys("word")).alias("_key"))
    terms = dictionary.select("field", "term", "bucket", "df", F.explode(_keys("term")).alias("_key"))
    met = terms.join(F.broadcast(keyed) if few else keyed, ["field", "_key"])
    band = F.abs(F.length("term") - F.length("word")) <= F.col("max_edits")
    pairs = met.where(band).withColumn("_edits", edits_between(F.col("term"), F.col("word"))).where("_edits <= max_edits")
    # A pair meets at several keys.
    pairs = pairs.select("clause", "field", "word", "term", "bucket", "df", "_edits").dropDuplicates(["clause", "field", "term"])
    closeness = F.when(F.col("_edits") == 0, 1.0).otherwise(1.0 - F.col("_edits") / F.least(F.length("word"), F.length("term")))
    close = pairs.withColumn("closeness", closeness).where("closeness > 0")
    shared = F.max("df").over(Window.partitionBy("clause", "field"))
    return close.select("clause", "field", "term", "bucket", shared.alias("df"), "closeness")
