"""The shingle join against all pairs, its bounds and trees, and the cases its docstring states."""

import random

import numpy as np

from wordloom.llm import overlap as O
from wordloom.llm import rtree

SCHEMA = "doc_id bigint, text string"


def grams(text):
    words = (text or "").encode().lower().split()
    k = min(4, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def expected(rows):
    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def check(spark, rows, **changes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS node", "'x' AS n", "2 AS s1")
    assert sorted(map(tuple, O.linked(df).collect()), key=repr) == expected(rows)


def family(base, n, edits, rng):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"w{rng.randrange(10**6)}"]
        out.append(" ".join(words))
    return out


def text(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


def corpus(rng):
    texts = [text(rng, rng.choice([1, 2, 3, 4, 5, 30, 200])) for _ in range(80)]
    for size, n, edits in ((150, 60, 6), (40, 25, 2), (12, 12, 1), (600, 12, 30)):
        texts += family(text(rng, size), n, edits, rng)
    line = text(rng, 25)
    texts += [f"{text(rng, 30)} {line}" for _ in range(30)]
    texts += [texts[100]] * 20 + [texts[100].upper() + "\n"] * 3
    return texts + [None, "", " \t\n", "one", "ONE", "one two", "é É", "é  É", "É É"]


def test_against_all_pairs(spark):
    rng = random.Random(3)
    texts = corpus(rng)
    rows = [(rng.choice([None, i, i, i, i // 2]), t) for i, t in enumerate(texts)]
    check(spark, rows)


def test_pages_lose_no_link(spark, monkeypatch):
    """Trees of a few points only, so that hot shingles and families are cut."""
    monkeypatch.setattr(O, "PAGE_BYTES", 128 * 10)
    check(spark, list(enumerate(corpus(random.Random(4)))))


def test_long_texts_in_more_groups(spark):
    rng = random.Random(5)
    base = text(rng, 12_000)
    check(spark, list(enumerate([base, base + " more words here", text(rng, 9_000), base[: len(base) * 9 // 10], base[: len(base) * 8 // 10]])))


def test_no_rows(spark):
    assert O.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_of_the_tree():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 900, rng.integers(20, 400)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(300)]
    sets += [np.unique(np.concatenate([s[3:], rng.integers(0, 2**60, 2).astype(np.uint64)])) for s in sets[:100]]
    sizes = np.array([len(s) for s in sets])
    tree = rtree.Tree(np.stack([O.count_vector(s, 128) for s in sets]), sizes, O.JACCARD)
    for i, s in enumerate(sets):
        links = {j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 85 * len(np.union1d(s, t))}
        assert links <= set(tree.near(i).tolist())


def test_folded_counts_are_counts():
    h = O.shingle_set(text(random.Random(7), 5000))
    assert (rtree.folded(O.count_vector(h, 1024), 128) == O.count_vector(h, 128)).all()
