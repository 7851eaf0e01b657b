import random

import pytest
from pyspark.sql import functions as F

from wordloom.functions import analysis, runs
from wordloom.functions.analysis import analyze, drop_stop_words, stem, tokenize
from wordloom.functions.lengths import quantize_length
from wordloom.operators import postings

# Words of the tables of the published stemmer paper, with their final stems.
PORTER = """caresses caress|ponies poni|ties ti|caress caress|cats cat|feed feed|agreed agre|
plastered plaster|bled bled|motoring motor|sing sing|conflated conflat|troubled troubl|sized size|
hopping hop|tanned tan|falling fall|hissing hiss|fizzed fizz|failing fail|filing file|happy happi|
sky sky|relational relat|conditional condit|rational ration|valenci valenc|hesitanci hesit|
digitizer digit|conformabli conform|radicalli radic|differentli differ|vileli vile|
analogousli analog|vietnamization vietnam|predication predic|operator oper|feudalism feudal|
decisiveness decis|hopefulness hope|callousness callous|formaliti formal|sensitiviti sensit|
sensibiliti sensibl|triplicate triplic|formative form|formalize formal|electriciti electr|
electrical electr|hopeful hope|goodness good|revival reviv|allowance allow|inference infer|
airliner airlin|gyroscopic gyroscop|adjustable adjust|defensible defens|irritant irrit|
replacement replac|adjustment adjust|dependent depend|adoption adopt|homologou homolog|
communism commun|activate activ|angulariti angular|homologous homolog|effective effect|
bowdlerize bowdler|probate probat|rate rate|cease ceas|controll control|roll roll|
apologi apolog|possibli possibl|yes ye|youth youth|ays ai|ay ay|by by|as as|s s"""


def column(spark, values, expr, schema="v string"):
    rows = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in rows.select(expr(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "text, words",
    [
        ("Hello, World!", ["hello", "world"]),
        ("can't won’t 'Sup!", ["can't", "won’t", "sup"]),
        ("wi-fi foo_bar x:y", ["wi", "fi", "foo_bar", "x:y"]),
        ("3.14 1,000 a1.b a1.2b 1.b", ["3.14", "1,000", "a1", "b", "a1.2b", "1", "b"]),
        ("U.S.A. shakespear.txt end.", ["u.s.a", "shakespear.txt", "end"]),
        ("日本語 ひら カタカナ", ["日", "本", "語", "ひ", "ら", "カタカナ"]),
        ("abc日本def", ["abc", "日", "本", "def"]),
        ("naïve Straße İstanbul ΣΑΣ", ["naïve", "straße", "istanbul", "σασ"]),
        ("co­op éte", ["co­op", "éte"]),
        ("", []),
        (" .,;: ", []),
    ],
)
def test_words(spark, text, words):
    assert column(spark, [text], tokenize) == [words]


def test_long_words_are_cut_and_long_runs_survive(spark):
    text = "x" * 600 + " y " + "z" * 300_000 + " " + "a." * 200_000 + "a"
    (words,) = column(spark, [text], tokenize)
    assert [len(w) for w in words[:4]] == [255, 255, 90, 1]
    assert max(map(len, words)) == 255
    assert "".join(words) == text.replace(" ", "")


def test_stop_words_leave_gaps(spark):
    (words,) = column(spark, ["Leave this dough under a cloth, then bake it."], lambda c: drop_stop_words(tokenize(c)))
    assert words == ["leave", None, "dough", "under", None, "cloth", None, "bake", None]


def test_whole_chain(spark):
    (terms,) = column(spark, ["Opening hours, EASTER and the holidays: we're baking from 4.30 to noon (not later)"], analyze)
    kept = [(i, t) for i, t in enumerate(terms) if t]
    assert kept == [
        (0, "open"), (1, "hour"), (2, "easter"), (5, "holidai"), (6, "we'r"), (7, "bake"), (8, "from"), (9, "4.30"), (11, "noon"), (13, "later"),
    ]


def test_porter(spark):
    pairs = [p.split() for p in PORTER.replace("\n", "").split("|")]
    assert column(spark, [w for w, _ in pairs], stem) == [s for _, s in pairs]


def test_quantized_length(spark):
    def expected(n):
        if n < 40:
            return n
        above = n - 24
        shift = above.bit_length() - 4
        return 24 + (above >> shift << shift)

    lengths = [*range(5000), 10**5, 10**7]
    assert column(spark, lengths, quantize_length, "v int") == [expected(n) for n in lengths]
    assert [expected(n) for n in (41, 100, 1000, 3000)] == [40, 96, 984, 2840]


def test_runs_equal_the_expressions(spark, monkeypatch):
    """Terms, counts and positions of the Arrow function are those of the expressions that analyse queries."""
    rng = random.Random(8)
    endings = ["", "s", "ies", "sses", "eed", "ed", "ing", *(r[0] for r in analysis.STEP2 + analysis.STEP3), *analysis.STEP4, "e", "lle", "ll", "y"]
    words = ["".join(rng.choice("abeiostyzéß1'") for _ in range(rng.randrange(1, 6))) + rng.choice(endings) + rng.choice(endings) for _ in range(4000)]
    texts = [" ".join(rng.choices(words + list(analysis.STOP_WORDS), k=300)) for _ in range(30)]
    texts += [None, "", "the of", "Yes yes", "x" * 300 + " is 東京 naïve", *map(" ".join, zip(*[iter(words)] * 100))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").repartition(2)
    monkeypatch.setattr(runs, "PIECE_WORDS", 250)
    got = docs.select("doc_id", runs.term_runs(analysis.tokenize(F.col("content"))).alias("r"), analysis.analyze_column("content").alias("a"))
    for row in got.collect():
        want = {}
        for i, t in enumerate(row.a or []):
            if t is not None:
                want.setdefault(t, []).append(i)
        assert [(r.term, r.tf, r.positions) for r in row.r] == [(t, len(p), p) for t, p in sorted(want.items())]
    # Not an expression of a thousand nodes for each word.
    plan = postings.analyze_documents(docs, ("content",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rlike") == 0 and plan.lower().count("runs(") == 1
