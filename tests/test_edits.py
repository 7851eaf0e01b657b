import itertools

import pytest
from pyspark.sql import functions as F

from wordloom.functions.edits import edits_up_to


def distance(a, b):
    """Edits with adjacent swaps, a swapped pair not edited again."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("max_edits", [0, 1, 2])
@pytest.mark.parametrize("word", ["ca", "abc", "abca", "aabcb"])
def test_against_brute_force(spark, word, max_edits):
    terms = ["".join(t) for n in range(1, 7) for t in itertools.product("abc", repeat=n)]
    found = (
        spark.createDataFrame([(t,) for t in terms], "t string")
        .select("t", edits_up_to(F.col("t"), word, max_edits).alias("e"))
        .where("e is not null")
        .collect()
    )
    expected = {t: distance(t, word) for t in terms if distance(t, word) <= max_edits}
    assert {r["t"]: r["e"] for r in found} == expected
