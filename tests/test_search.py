import itertools
import math
import random
from collections import Counter
from pathlib import Path

import pytest

from wordloom.functions.analysis import STOP_WORDS
from wordloom.operators import clauses as Q
from wordloom.operators import postings
from wordloom.operators.topk import top_k
from wordloom.operators.phrases import apart
from wordloom.plans.clause_table import KINDS as TABLE_KINDS
from wordloom.plans.clause_table import score_clauses
from wordloom.plans.search import Searcher
from wordloom.plans.store import IndexStore
from wordloom.plans.sync import sync
from wordloom.sources.files import scan_files

# By hand from the formulas: lengths 9, 7, 8, 6, 4 of five contents and 1, 1, 2, 4, 1, 1 of six titles.
GOLDEN = {
    ("dough", "ok"): [("bread.txt", 0.501532), ("starter.htm", 0.445215), ("menu.html", 0.371146)],
    ("water oven", "ok"): [("oven.txt", 1.015851), ("starter.htm", 0.418061)],
    ("price of flour", "ok"): [("starter.htm", 0.661994), ("menu.html", 0.647246)],
    ("dough", "vs"): [("starter.htm", 1.126381), ("bread.txt", 0.798157), ("menu.html", 0.598618)],
    ("water oven", "vs"): [("oven.txt", 1.43315), ("starter.htm", 0.691224)],
    ("price of flour", "vs"): [("menu.html", 1.592944), ("starter.htm", 0.856755)],
    ("it was no such", "ok"): [],
    ("archive", "vs"): [],
}


@pytest.mark.parametrize("query, model", GOLDEN)
def test_golden(spark, sample_folder, tmp_path, query, model):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, scan_files(spark, sample_folder))
    rows = Searcher(store, model.upper()).search([Q.term(query)]).collect()
    assert [(r["file_name"], r["score"]) for r in rows] == GOLDEN[query, model]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    for r in rows:
        html = r["file_name"].endswith((".htm", ".html"))
        assert (r["display_title"] == r["title"]) if html else r["display_title"] is None


# -- a random corpus and the same semantics in plain Python -------------------

WORDS = ["kal", "kalo", "mun", "mur", "pir", "pirk", "the", "zol"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(7)
    docs = {}
    for i in range(150):
        n = rng.choice([0, 1, 2, 5, 9, 30, 60])
        weights = [rng.random() + 0.05 for _ in WORDS]
        docs[i] = {
            "content": rng.choices(WORDS, weights, k=n),
            "title": rng.choices(WORDS, weights, k=rng.randint(0, 3)),
        }
    # A third of all documents are copies of one.
    for i in range(150, 220):
        docs[i] = docs[3]
    rows = [(i, f"p/{i}.txt", " ".join(d["title"]), " ".join(d["content"])) for i, d in docs.items()]
    store = IndexStore(spark, str(tmp_path_factory.mktemp("ix") / "index"), buckets=3, shards=2)
    sync(store, spark.createDataFrame(rows, "doc_id bigint, path string, title string, content string"))
    return docs, store


class Plain:
    """The scoring rules without Spark."""

    def __init__(self, docs, model="ok"):
        self.model = model
        self.positions = {}
        for i, d in docs.items():
            for f, words in d.items():
                for pos, w in enumerate(words):
                    if w not in STOP_WORDS:
                        self.positions.setdefault((f, w), {}).setdefault(i, []).append(pos)
        self.dl = {
            (f, i): sum(w not in STOP_WORDS for w in d[f]) for i, d in docs.items() for f in d
        }
        self.docs = docs

    def stats(self, f):
        lengths = [n for (g, _), n in self.dl.items() if g == f and n]
        return len(lengths), sum(lengths) / len(lengths)

    def idf(self, f, df):
        n, _ = self.stats(f)
        if self.model == "ok":
            return math.log(1 + (n - df + 0.5) / (df + 0.5))
        return math.log((n + 1) / (df + 1)) + 1

    def score(self, f, i, tf, idf):
        dl = self.dl[f, i]
        if dl >= 40:
            s = (dl - 24).bit_length() - 4
            dl = 24 + ((dl - 24) >> s << s)
        if self.model == "ok":
            return idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / self.stats(f)[1]))
        return idf * math.sqrt(tf) / math.sqrt(dl)

    def evaluate(self, clause):
        """doc -> score of the documents a clause matches; None: no clause."""
        fields = [clause.field] if clause.field else ["content", "title"]
        out = Counter()
        if clause.kind == "group":
            return self.group(clause.clauses, clause.boost)
        if clause.kind == "all":
            return dict.fromkeys(self.docs, clause.boost)
        words = [(p, w) for p, w in enumerate(clause.text.split()) if w not in STOP_WORDS]
        if clause.kind in ("term", "phrase") and not words:
            return None
        for f in fields:
            if clause.kind == "term" or (clause.kind == "phrase" and len(words) == 1):
                for _, w in words:
                    where = self.positions.get((f, w), {})
                    for i, ps in where.items():
                        out[i] += clause.boost * self.score(f, i, len(ps), self.idf(f, len(where)))
            elif clause.kind == "phrase":
                lists = [self.positions.get((f, w), {}) for _, w in words]
                idf = sum(self.idf(f, len(p)) for p in lists)
                for i in set.intersection(*map(set, lists)):
                    shifted = [[x - (p - words[0][0]) for x in l[i]] for (p, _), l in zip(words, lists)]
                    terms = [w for _, w in words]
                    if clause.slop and len(set(terms)) < len(terms):
                        tf = apart(shifted, terms, clause.slop)
                    else:
                        tf = sloppy(shifted, clause.slop) if clause.slop else len(set.intersection(*map(set, shifted)))
                    if tf:
                        out[i] += clause.boost * self.score(f, i, tf, idf)
            else:
                docs = set()
                for (g, w), where in self.positions.items():
                    if g == f and matches(clause, w):
                        docs |= set(where)
                for i in docs:
                    out[i] += clause.boost
        return dict(out)

    def group(self, clauses, boost=1.0):
        results = [(c.occur, self.evaluate(c)) for c in clauses]
        results = [(o, r) for o, r in results if r is not None]
        if not results:
            return None
        must = [r for o, r in results if o == "must"]
        should = [r for o, r in results if o == "should"]
        out = {}
        for i in self.docs:
            ok = all(i in r for r in must) if must else any(i in r for r in should)
            if ok and not any(i in r for o, r in results if o == "must_not"):
                out[i] = boost * sum(r.get(i, 0) for r in must + should)
        return out


def matches(clause, w):
    if clause.kind == "prefix":
        return w.startswith(clause.text)
    if clause.kind == "range":
        low = clause.lower is None or (w >= clause.lower if clause.include_lower else w > clause.lower)
        high = clause.upper is None or (w <= clause.upper if clause.include_upper else w < clause.upper)
        return low and high
    import re

    pattern = clause.text
    if clause.kind == "wildcard":
        pattern = pattern.replace("?", ".").replace("*", ".*")
    return re.fullmatch(pattern, w) is not None


def sloppy(lists, slop):
    """Sweep: one pointer per term, always advance the smallest."""
    points = [list(zip(sorted(l), itertools.repeat(j))) for j, l in enumerate(lists)]
    at = [0] * len(points)
    freq = 0.0
    while True:
        current = [p[a] for p, a in zip(points, at)]
        j = current.index(min(current))
        others = [c[0] for k, c in enumerate(current) if k != j]
        end = max(others)
        width = max(end, current[j][0]) - current[j][0]
        while True:
            at[j] += 1
            if at[j] == len(points[j]):
                return freq + (1 / (1 + width) if width <= slop else 0)
            x = points[j][at[j]][0]
            if x > min(others):
                break
            width = min(width, end - x)
        if width <= slop:
            freq += 1 / (1 + width)


T, P = Q.term, Q.phrase
CASES = {
    "should": [T("kal"), T("mun")],
    "title only": [T("kal", "title")],
    "several terms": [T("kal mun kal")],
    "must": [T("kal", occur="must"), T("mun", occur="must"), T("pir")],
    "must, several terms": [T("kal zol", occur="must"), T("mun")],
    "must not": [T("kal"), T("mun", occur="must_not")],
    "only must not": [T("kal", occur="must_not")],
    "required stop word": [T("the", occur="must"), T("kal", occur="must")],
    "only stop words": [T("the")],
    "boost": [T("kal", boost=3.0), T("mun", boost=0.25)],
    "zero boost": [T("kal", boost=0.0)],
    "group": [T("zol"), Q.group(T("kal", occur="must"), T("mun", occur="must_not"), boost=2.0)],
    "deep": [
        Q.group(Q.group(T("kal"), T("pir"), occur="must"), Q.group(T("mun"), T("zol"), occur="must"), occur="must"),
        Q.group(T("pirk", occur="must_not"), T("mur"), occur="must_not"),
    ],
    "group of nothing": [Q.group(T("the"), occur="must"), T("kal")],
    "phrase": [P("kal mun")],
    "phrase of three": [P("kal mun pir")],
    "phrase with a gap": [P("kal the mun")],
    "phrase with a repeated term": [P("kal kal")],
    "phrase of one": [P("the kal")],
    "phrase with an unknown term": [P("kal nowhere"), T("zol")],
    "sloppy": [P("kal mun", slop=2)],
    "sloppy of three": [P("kal mun pir", slop=5)],
    "sloppy with a gap": [P("kal the zol", slop=3)],
    "sloppy with a repeated term": [P("kal mun kal", slop=3)],
    "sloppy phrases of all kinds": [P("kal kal", slop=2), P("mun kal", slop=1), P("mun kal"), P("mun zol mun", slop=9, occur="must")],
    "phrases together": [P("kal mun"), P("mun kal", slop=4, boost=2.0), T("zol", occur="must")],
    "prefix": [Q.prefix("pi")],
    "wildcard": [Q.wildcard("k?l*", boost=2.0)],
    "regexp": [Q.regexp("mu[nr]", "content")],
    "range": [Q.term_range("kalo", "mur", include_upper=False)],
    "open range": [Q.term_range("mur", None, include_lower=False, occur="must"), T("kal")],
    "all": [Q.match_all(boost=0.5), T("kal")],
    "constant must not": [T("kal"), Q.prefix("pi", occur="must_not")],
}


@pytest.fixture(scope="module")
def answers(corpus):
    """All cases as one batch of queries per model."""
    _, store = corpus
    out = {}
    for model in ("ok", "vs"):
        rows = Searcher(store, model).score(dict(enumerate(CASES.values()))).collect()
        for i, name in enumerate(CASES):
            out[model, name] = {r["doc_id"]: r["score"] for r in rows if r["query_id"] == i}
    return out


@pytest.mark.parametrize("model", ["ok", "vs"])
@pytest.mark.parametrize("name", CASES)
def test_against_plain_python(corpus, answers, name, model):
    found = answers[model, name]
    expected = Plain(corpus[0], model).group(CASES[name]) or {}
    assert found.keys() == expected.keys()
    for i, score in expected.items():
        assert found[i] == pytest.approx(score, abs=2e-6)
        assert found[i] >= 0


def test_plans_for_large_inputs_give_the_same(spark, corpus, answers, monkeypatch):
    """Nothing broadcast, no term as a literal where the number may be large."""
    monkeypatch.setattr("wordloom.plans.search.BROADCAST_ROWS", 0)
    monkeypatch.setattr("wordloom.plans.search.LITERAL_TERMS", 1)
    monkeypatch.setattr("wordloom.plans.search.ONE_TASK_ROWS", 0)
    _, store = corpus
    searcher = Searcher(store)
    names = ["deep", "phrase of three", "sloppy", "prefix", "wildcard", "constant must not"]
    rows = searcher.score({i: CASES[n] for i, n in enumerate(names)}).collect()
    for i, name in enumerate(names):
        assert {r["doc_id"]: r["score"] for r in rows if r["query_id"] == i} == pytest.approx(
            answers["ok", name], abs=2e-6
        )
    table = spark.createDataFrame([(0, "kal mun kal"), (1, "zol")], "query_id int, text string")
    large = {(r["query_id"], r["rank"]): r["doc_id"] for r in searcher.search_texts(table, k=5).collect()}
    for q, text in ((0, "kal mun kal"), (1, "zol")):
        for r in searcher.search([T(text)], k=5).collect():
            assert large[q, r["rank"]] == r["doc_id"]


def test_anchored_on_required_terms(corpus, answers, monkeypatch):
    from wordloom.plans import search

    monkeypatch.setattr(search, "ANCHOR_GAIN", 0)
    split = []
    original = search._split_by_anchor
    monkeypatch.setattr(search, "_split_by_anchor", lambda *a: split.append(original(*a)) or split[-1])
    names = ["must", "must, several terms", "should", "required stop word", "open range", "group"]
    rows = Searcher(corpus[1]).score({i: CASES[n] for i, n in enumerate(names)}).collect()
    assert split[0][1] and split[0][2]
    for i, name in enumerate(names):
        assert {r["doc_id"]: r["score"] for r in rows if r["query_id"] == i} == pytest.approx(
            answers["ok", name], abs=2e-6
        )


def test_many_queries_at_once(corpus):
    docs, store = corpus
    searcher = Searcher(store)
    names = ["should", "must not", "phrase", "prefix", "deep", "only stop words"]
    together = searcher.search({i: CASES[n] for i, n in enumerate(names)}, k=7).collect()
    for i, n in enumerate(names):
        alone = searcher.search(CASES[n], k=7).collect()
        mine = [r for r in together if r["query_id"] == i]
        assert [(r["rank"], r["doc_id"], r["score"]) for r in mine] == [
            (r["rank"], r["doc_id"], r["score"]) for r in alone
        ]


def test_table_of_texts(spark, corpus):
    _, store = corpus
    searcher = Searcher(store)
    texts = {1: "kal mun kal", 2: "the", 3: "zol nowhere"}
    table = spark.createDataFrame(list(texts.items()), "query_id int, text string")
    found = searcher.search_texts(table, k=5).collect()
    for q, text in texts.items():
        alone = searcher.search([T(text)], k=5).collect()
        mine = sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["query_id"] == q)
        assert mine == [(r["rank"], r["doc_id"], r["score"]) for r in alone]


@pytest.mark.parametrize("model", ["ok", "vs"])
@pytest.mark.parametrize("k, first", [(1, 1), (4, 2), (10, 20), (300, 1)])
def test_bounded_top_k_is_the_top_k(spark, corpus, monkeypatch, model, k, first):
    monkeypatch.setattr("wordloom.plans.search.FIRST_ROWS", first)
    _, store = corpus
    searcher = Searcher(store, model)
    texts = ["kal mun kal", "the", "zol nowhere pirk", "kal kalo mun mur pir pirk zol zol zol", "pirk", ""]
    table = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    found = searcher.top_texts(table, k).collect()
    whole = top_k(searcher.score_texts(table), k).collect()
    assert sorted(map(tuple, (r.asDict().values() for r in found))) == sorted(map(tuple, (r.asDict().values() for r in whole)))


def test_bounded_top_k_scores_fewer(spark, tmp_path):
    """Common words cannot lift a document over ten that hold the rare ones."""
    rows = [(i, f"{i}.txt", "", "common usual " * (1 + i % 3) + ("rare seldom scarce" if i % 300 == 0 else "")) for i in range(6000)]
    store = IndexStore(spark, str(tmp_path / "index"), buckets=2, shards=2)
    sync(store, spark.createDataFrame(rows, "doc_id bigint, path string, title string, content string"))
    searcher = Searcher(store)
    table = spark.createDataFrame([(1, "rare seldom scarce common usual")], "query_id int, text string")
    counted = []
    with pytest.MonkeyPatch.context() as m:
        hits = Searcher._term_hits
        m.setattr(Searcher, "_term_hits", lambda *a: counted.append(hits(*a)) or counted[-1])
        found = searcher.top_texts(table, 10).collect()
    scored = sum(part.select("query_id", "doc_id").distinct().count() for part in counted)
    assert scored <= searcher.score_texts(table).count() / 10
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"])] == [
        r["doc_id"] for r in sorted(top_k(searcher.score_texts(table), 10).collect(), key=lambda r: r["rank"])
    ]


def as_rows(queries):
    """A clause table of queries given as clauses."""
    rows = []

    def add(query_id, clauses, parent):
        for c in clauses:
            rows.append((query_id, len(rows), parent, c.occur, c.kind, c.text, c.field, float(c.boost), c.slop))
            add(query_id, c.clauses, len(rows) - 1)

    for query_id, clauses in queries.items():
        add(query_id, clauses, None)
    return rows


TABLE = "query_id int, clause_id bigint, parent_id bigint, occur string, kind string, text string, field string, boost double, slop int"


def in_table(clauses):
    return all(c.kind in TABLE_KINDS and in_table(c.clauses) for c in clauses)


@pytest.mark.parametrize("model", ["ok", "vs"])
def test_clauses_as_a_table(spark, corpus, model):
    _, store = corpus
    queries = {i: CASES[n] for i, n in enumerate(sorted(CASES)) if in_table(CASES[n])}
    gone = Q.group(T("the", occur="must"), occur="must")
    queries |= {
        900: [gone, T("kal")],
        901: [Q.group(T("the"), T("mun", occur="must_not"), occur="must"), T("kal")],
        902: [Q.phrase("the", occur="must"), Q.phrase("mun the kal", slop=1), Q.phrase("kal mun", boost=3.0)],
        903: [Q.group(Q.group(T("zol", occur="must"), T("pir mur", boost=2.0), boost=3.0), Q.prefix("ka", "title"), occur="must"), Q.match_all(boost=0.5)],
        904: [T("mun", occur="must_not")],
    }
    assert len(queries) > 12
    searcher = Searcher(store, model)
    found = score_clauses(searcher, spark.createDataFrame(as_rows(queries), TABLE)).collect()
    for q, clauses in queries.items():
        alone = {r["doc_id"]: r["score"] for r in searcher.score(clauses).collect()}
        mine = {r["doc_id"]: r["score"] for r in found if r["query_id"] == q}
        assert mine.keys() == alone.keys(), q
        assert all(mine[d] == pytest.approx(alone[d], abs=2e-6) for d in mine)


def test_thousands_of_queries_in_one_table(spark, corpus):
    _, store = corpus
    searcher = Searcher(store)
    queries = {i: [T(WORDS[i % 8], occur="must"), Q.group(T(WORDS[i % 5]), T(WORDS[i % 3], occur="must_not"))] for i in range(10_000)}
    found = score_clauses(searcher, spark.createDataFrame(as_rows(queries), TABLE))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    one = {(r["doc_id"], r["score"]) for r in found.where("query_id = 9999").collect()}
    assert one == {(r["doc_id"], r["score"]) for r in searcher.score(queries[9999]).collect()}


@pytest.mark.parametrize(
    "row",
    [
        (1, 1, None, "maybe", "term", "kal", None, 1.0, 0),
        (1, 1, None, "must", "regexp", "kal", None, 1.0, 0),
        (1, 1, 7, "must", "term", "kal", None, 1.0, 0),
        (1, 1, None, "must", "term", "kal", None, -1.0, 0),
    ],
)
def test_wrong_clause_rows(spark, corpus, row):
    with pytest.raises(ValueError):
        score_clauses(Searcher(corpus[1]), spark.createDataFrame([row], TABLE))


def test_ties_go_to_the_lower_id(corpus):
    _, store = corpus
    rows = Searcher(store).search([Q.match_all()], k=12).collect()
    assert [r["doc_id"] for r in rows] == list(range(12))


def test_fuzzy(corpus):
    docs, store = corpus
    plain = Plain(docs)
    found = {r["doc_id"]: r["score"] for r in Searcher(store, fields=["content"]).score([Q.fuzzy("kla", 1)]).collect()}
    # One swap from kal; kalo needs a second edit.
    where = plain.positions["content", "kal"]
    weight = 1 - 1 / 3
    assert found.keys() == where.keys()
    for i, ps in where.items():
        expected = weight * plain.score("content", i, len(ps), plain.idf("content", len(where)))
        assert found[i] == pytest.approx(expected, abs=2e-6)
    # Two edits: kal and kalo share the larger document frequency.
    df = max(len(plain.positions["content", w]) for w in ("kal", "kalo"))
    found = {r["doc_id"]: r["score"] for r in Searcher(store, fields=["content"]).score([Q.fuzzy("kla", 2)]).collect()}
    expected = Counter()
    for w, edits in (("kal", 1), ("kalo", 2)):
        for i, ps in plain.positions["content", w].items():
            expected[i] += (1 - edits / 3) * plain.score("content", i, len(ps), plain.idf("content", df))
    assert found.keys() == expected.keys()
    for i in expected:
        assert found[i] == pytest.approx(expected[i], abs=2e-6)


def test_clause_table(corpus):
    _, store = corpus
    rows = [
        {"query_id": 4, "clause_id": 1, "parent_id": None, "kind": "term", "text": "zol"},
        {"query_id": 4, "clause_id": 2, "parent_id": None, "kind": "group", "boost": 2.0},
        {"query_id": 4, "clause_id": 3, "parent_id": 2, "kind": "term", "text": "kal", "occur": "must"},
        {"query_id": 4, "clause_id": 5, "parent_id": 2, "kind": "term", "text": "mun", "occur": "must_not"},
    ]
    assert Q.from_rows(rows) == {4: CASES["group"]}


@pytest.mark.parametrize(
    "wrong",
    [
        lambda s: Searcher(s, "tfidf"),
        lambda s: Searcher(s).search([T("kal")], k=0),
        lambda s: Q.wildcard("*x"),
        lambda s: Q.term("x", occur="maybe"),
        lambda s: Q.fuzzy("x", 3),
    ],
)
def test_wrong_arguments(corpus, wrong):
    with pytest.raises(ValueError):
        wrong(corpus[1])


def test_query_reads_only_its_folders(corpus):
    _, store = corpus
    plan = Searcher(store).score([T("kal")])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [kal])" in plan or "EqualTo(term,kal)" in plan
    assert "positions" not in plan
    assert "PartitionFilters: [(bucket" in plan.replace("isnotnull(bucket", "") or "bucket#" in plan


def test_text_lengths_do_not_stem(spark):
    rows = [(1, "The baker's ovens, running: ovens", "a.txt"), (2, "", "of the"), (3, None, None), (4, "it was", "x 7 ß")]
    corpus = spark.createDataFrame(rows, "doc_id bigint, content string, title string")
    found = postings.text_lengths(corpus)
    expected = postings.doc_lengths(postings.build_postings(corpus))
    assert sorted(found.collect()) == sorted(expected.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < len(expected._jdf.queryExecution().optimizedPlan().toString()) / 4


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def dealt_by_document(spark, tmp_path):
    rows = [(i, f"{i}.txt", f"{i}.txt", f"word{i % 7} dough bread{i % 5} dough") for i in range(40)]
    store = IndexStore(spark, str(tmp_path / "dealt"))
    sync(store, spark.createDataFrame(rows, "doc_id bigint, path string, title string, content string"))
    return Searcher(store)


def test_postings_travel_once_by_document(spark, tmp_path):
    searcher = dealt_by_document(spark, tmp_path)
    texts = spark.createDataFrame([(1, "dough bread1"), (2, "dough bread2 word3")], "query_id bigint, text string")
    assert not [line for line in exchanges(searcher.score_texts(texts)) if "query_id" in line and "doc_id" in line]
    clauses = [(1, 1, "must", "term", "dough"), (1, 2, "should", "phrase", "dough bread1"), (2, 1, "must", "fuzzy", "bread"), (2, 2, "must", "fuzzy", "bread")]
    table = spark.createDataFrame(clauses, "query_id bigint, clause_id int, occur string, kind string, text string")
    found = score_clauses(searcher, table)
    # Words with their frequencies are grouped by term; no score or position travels by query.
    assert not [line for line in exchanges(found) if "query_id" in line and "doc_id" in line]
    rows = {(r["query_id"], r["doc_id"]): r["score"] for r in found.collect()}
    assert {d for q, d in rows if q == 1} == set(range(40)) and {d for q, d in rows if q == 2} == set(range(40))
    assert len({rows[1, d] for d in range(40) if d % 5 == 1}) == 1 and rows[1, 1] > rows[1, 0]


def test_phrase_of_frequent_terms_is_not_broadcast(spark, tmp_path):
    found = dealt_by_document(spark, tmp_path).score([Q.phrase("dough dough")])
    assert not [line for line in exchanges(found) if "phrase_id" in line]
    assert found.isEmpty()
