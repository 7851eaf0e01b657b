"""Ranked search against plain sums, and the cases its docstring states."""

import math
import random
import re
from collections import Counter

from wordloom.llm import ranking as R


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, **options):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).selectExpr("*", "1 AS item", "2 AS score", "'q' AS term")
    right = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "2 AS part")
    found = R.rank(left, right, **options).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, found), key=repr) == expected(docs, items, options.get("k", 10))


def words(rng, n):
    return " ".join(rng.choice(["Alpha", "beta", "γάμμα", "d4", "e", "the", "the", "w%d" % rng.randrange(400)]) + rng.choice(["", ",", "_", "\x7f"]) for _ in range(n))


def test_against_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 64)
    monkeypatch.setattr(R, "ITEMS", 4)
    rng = random.Random(2)
    docs = [(i, words(rng, rng.randrange(1, 60))) for i in range(400)]
    docs += [(i % 7, "the alpha w7 w8") for i in range(60)]  # ties and repeated ids
    docs += [(None, "alpha w9"), (None, "alpha w9"), (900, None), (901, ""), (902, " .,"), (903, words(rng, 20_000))]
    items = [(i, words(rng, 12)) for i in range(20)] + [(3, "the alpha w7 w8"), (5, "ALPHA alpha"), (5, "ALPHA alpha"), (6, None), (7, "?!"), (8, "nowhere"), (None, "w9")]
    check(spark, docs, items)
    check(spark, docs, items, k=3, stages=1)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a b")], [])
    check(spark, [(1, "a b"), (2, None)], [(1, "a")])
