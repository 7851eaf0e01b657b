"""Sloppy phrases that hold a term more than once."""

import itertools
import os
import random

import pytest
from wordloom.catalog.queries import queries
from wordloom.catalog.session import documents_index
from test_search import sloppy
from wordloom.operators.phrases import apart


def shifted(text, phrase):
    words, places = text.split(), phrase.split()
    return [[i - j for i, w in enumerate(words) if w == p] for j, p in enumerate(places)]


def narrowest(text, phrase):
    """Least width over all ways to give the places different positions."""
    words, places = text.split(), phrase.split()
    at = [[i for i, w in enumerate(words) if w == p] for p in places]
    widths = [
        max(p - j for j, p in enumerate(ps)) - min(p - j for j, p in enumerate(ps))
        for ps in itertools.product(*at)
        if len(set(ps)) == len(ps)
    ]
    return min(widths, default=None)


@pytest.mark.parametrize(
    "text, phrase, slop, freq",
    [
        ("a b", "a b a", 9, 0),
        ("a b a", "a b a", 1, 1),
        ("a a", "a a", 1, 1),
        ("a", "a a", 5, 0),
        ("a x a", "a a", 1, 1 / 2),
        ("a x a", "a a", 0, 0),
        ("b a a", "a b a", 2, 1 / 3),
        ("b a a", "a b a", 1, 0),
        ("a a a", "a a", 1, 2),
        ("a b a x x x x x a b a", "a b a", 1, 2),
    ],
)
def test_by_hand(text, phrase, slop, freq):
    assert apart(shifted(text, phrase), phrase.split(), slop) == pytest.approx(freq)


def test_like_the_plain_walk_without_repeats():
    rng = random.Random(3)
    for _ in range(3000):
        n = rng.choice([2, 3, 4])
        starts = [sorted(rng.sample(range(25), rng.randint(1, 6))) for _ in range(n)]
        slop = rng.randint(1, 9)
        assert apart(starts, list(range(n)), slop) == pytest.approx(sloppy(starts, slop))


@pytest.mark.parametrize("phrase", ["a b a", "a a", "a a b", "b a a c", "a b a b", "a a a"])
def test_against_all_assignments(phrase):
    rng = random.Random(phrase)
    seen = set()
    for _ in range(1500):
        text = " ".join(rng.choices("abcx", [4, 3, 2, 4], k=rng.randint(1, 12)))
        slop = rng.randint(1, 6)
        least = narrowest(text, phrase)
        freq = apart(shifted(text, phrase), phrase.split(), slop) if all(shifted(text, phrase)) else 0
        assert (freq > 0) == (least is not None and least <= slop), (text, slop)
        seen.add(freq > 0)
    assert len(seen) == 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    found = {r["doc_id"] for r in queries()["phrase_slop3"](spark, folder).collect()}
    held = documents_index(spark, folder).postings().where("field = 'content' and term in ('from', 'ed')")
    texts = {}
    for r in held.collect():
        texts.setdefault(r["doc_id"], {}).update(dict.fromkeys(r["positions"], r["term"]))
    texts = {d: " ".join(at.get(i, "-") for i in range(max(at) + 1)) for d, at in texts.items()}
    widths = {d: narrowest(t, "from ed from") for d, t in texts.items()}
    assert found == {d for d, w in widths.items() if w is not None and w <= 6}
