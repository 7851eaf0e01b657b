"""Fuzzy clauses as a table, against edit distances worked out letter by letter."""

import random

import pytest
from pyspark.sql import functions as F

from wordloom.operators import fuzzy


def distance(a: str, b: str) -> int:
    """Insertions, deletions, exchanges and swaps of neighbours; a swapped pair is not edited again."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def edited(rng: random.Random, word: str) -> str:
    w = list(word)
    for _ in range(rng.randrange(4)):
        i = rng.randrange(len(w) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            w.insert(i, rng.choice("abé😀"))
        elif kind == 1 and i < len(w):
            w[i] = rng.choice("abé")
        elif kind == 2 and i < len(w):
            del w[i]
        elif i + 1 < len(w):
            w[i], w[i + 1] = w[i + 1], w[i]
    return "".join(w)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 14))) for _ in range(40)] + ["x" * 300]
    return sorted({edited(rng, w) for w in base for _ in range(12)} | set(base))


def test_edits_between_columns(spark, words):
    sample = words[::3]
    pairs = spark.createDataFrame([(a, b) for a in sample for b in sample if abs(len(a) - len(b)) <= 3], "term string, word string")
    got = pairs.select("term", "word", fuzzy.edits_between(F.col("term"), F.col("word")).alias("n")).collect()
    for r in got:
        n = distance(r.term, r.word) if len(r.term) < 50 else None
        assert n is None or r.n == (n if n <= 2 else None), r
    assert {r.n for r in got} == {0, 1, 2, None}


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("prefix", [3, fuzzy.PREFIX])
def test_expand(spark, words, few, prefix, monkeypatch):
    monkeypatch.setattr(fuzzy, "PREFIX", prefix)
    terms = [(f, w, 0, i) for i, w in enumerate(words) for f in ("body", "head")[: 1 + i % 2] if w]
    dictionary = spark.createDataFrame(terms, "field string, term string, bucket int, df long")
    asked = [(n, "body", w, n % 3) for n, w in enumerate(words[::5])] + [(900, "head", words[7], 2), (901, "body", "", 2), (902, "body", None, 1)]
    got = fuzzy.expand(dictionary, spark.createDataFrame(asked, "clause int, field string, word string, max_edits int"), few).collect()
    want = {}
    for clause, field, word, most in asked:
        near = {}
        for f, t, _, df in terms:
            if word and f == field and abs(len(t) - len(word)) <= most and (n := distance(t, word)) <= most:
                closeness = 1.0 if n == 0 else 1.0 - n / min(len(word), len(t))
                if closeness > 0:
                    near[clause, f, t] = (df, closeness)
        most_df = max((df for df, _ in near.values()), default=0)
        want |= {k: (most_df, pytest.approx(c)) for k, (_, c) in near.items()}
    assert len(got) == len(want) and {(r.clause, r.field, r.term): (r.df, r.closeness) for r in got} == want


def test_expand_of_nothing(spark):
    dictionary = spark.createDataFrame([], "field string, term string, bucket int, df long")
    asked = spark.createDataFrame([(1, "body", "word", 2)], "clause int, field string, word string, max_edits int")
    assert fuzzy.expand(dictionary, asked, True).count() == 0
    assert fuzzy.expand(dictionary, asked.where("false"), False).count() == 0
