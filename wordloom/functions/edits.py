"""Edit distance with adjacent swaps, for a fixed word and small bounds.

Spark's ``levenshtein`` counts a swap of neighbours as two edits.  Here it is
one, and a swapped pair is not edited again.  The word is a query word, so
everything that depends on it alone is prepared as literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _swaps(word: str) -> list[tuple[str, str, str]]:
    """(before, swapped pair, after) for each pair of different neighbours."""
    return [
        (word[:i], word[i + 1] + word[i], word[i + 2 :])
        for i in range(len(word) - 1)
        if word[i] != word[i + 1]
    ]


def _within(a: Column, b: str, n: int) -> Column:
    return F.levenshtein(a, F.lit(b), n) >= 0


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def edits_up_to(term: Column, word: str, max_edits: int) -> Column:
    """0, 1 or 2 edits between term and word; null when above ``max_edits``."""
    swaps = _swaps(word)
    once = [a + pair + c for a, pair, c in swaps]
    twice = sorted({a + pair + x + p + y for a, pair, c in swaps for x, p, y in _swaps(c)})
    one = _within(term, word, 1) | term.isin(*once)
    two = _within(term, word, 2) | term.isin(*twice)
    for a, pair, c in swaps:
        head, tail = a + pair, pair + c
        two = two | (
            F.startswith(term, F.lit(head))
            & _within(F.substring(term, len(head) + 1, 1 << 30), c, 1)
        )
        two = two | (
            F.endswith(term, F.lit(tail))
            & _within(F.substring(term, F.lit(1), F.length(term) - len(tail)), a, 1)
        )
    in_band = F.length(term).between(max(1, len(word) - max_edits), len(word) + max_edits)
    edits = F.when(term == word, 0)
    if max_edits >= 1:
        edits = edits.when(one, 1)
    if max_edits >= 2:
        edits = edits.when(two, 2)
    return F.when(in_band, edits)
