"""Each operator against brute force, on rows with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import contamination, exact, language, licenses, mixing, near, quality, repeats, rtree, sharding, tokens
from wordloom.llm.suffixes import longest_repeats, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, size int, kept string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows():
    rng = random.Random(3)
    base = words(rng, 120)
    near_copy = base.split()
    near_copy[60] = "changed"
    passage = words(rng, 60)
    texts = [
        base, base.upper(), " ".join(near_copy), None, "", "   ", "12 ! 34", "word", "word", words(rng, 5000),
        words(rng, 80) + " " + passage, passage + " " + words(rng, 90), "x" * 450, "x" * 199,
        "Released under the MIT License. é È Licensed under CC BY-NC 4.0; under  the\nMIT license",
        "Licensed under the GNU General Public License, version 3", "a  b\n\n c \t<|endoftext|>d's  ",
    ]
    out = [(i, t, "ab"[i % 2], f"s{i % 3}", 1, "mine", 2, "x") for i, t in enumerate(texts)]
    out += [out[0], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact(docs, nothing):
    got = Counter(tuple(r) for r in exact.deduplicate(docs).collect())
    groups = {}
    for r in rows():
        groups.setdefault(plain(r[1]), []).append(r[0])
    want = Counter()
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[-1] if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = True
        for i in ids:
            stays = i == keep and left
            left = left and not stays
            want[i, keep, len(ids), stays, digest] += 1
    assert got == want
    assert exact.deduplicate(nothing).count() == 0


def test_cuckoo_resizes_and_deletes():
    index, keys = exact.CuckooIndex(2), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    assert all(index.insert(k)[1] for k in keys) and not index.insert(keys[5])[1]
    assert all(index.find(k) >= 0 for k in keys)
    for k in keys[::2]:
        index.delete(k)
    assert [index.find(k) >= 0 for k in keys] == [i % 2 == 1 for i in range(3000)]
    assert index.insert(keys[0])[1] and index.find(keys[0]) >= 0


def test_index_updates(spark):
    key = lambda x: hashlib.sha256(x.encode()).digest()
    step = lambda *xs: spark.createDataFrame([(key(k), n) for k, n in xs], "digest binary, step int")
    first = exact.update(None, step(("a", 1), ("b", 1), ("a", 1), ("c", -1)), 4)
    second = exact.update(first, step(("a", -1), ("b", -1), ("d", 1)), 4)
    assert {bytes(r.digest): r.live for r in second.collect()} == {key("a"): 1, key("d"): 1}


def test_near(docs, nothing):
    data = rows()
    texts = [r[1] or "" for r in data]
    counts = np.zeros(near.DF_SLOTS + 1, np.int64)
    for t in texts:
        counts[np.unique(near.words(t) & np.uint64(near.DF_SLOTS - 1)).astype(int)] += 1
    counts[-1] = len(texts)
    assert (near.document_frequencies(docs) == counts).all()
    v = [near.weighted(t, near.idf(counts)) for t in texts]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or near.similarity(v[i], v[j]) >= 0.8:
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    want = Counter()
    for p in set(parent):
        ids = [data[i][0] for i in range(len(data)) if parent[i] == p]
        first = min((i for i in ids if i is not None), default=None)
        want.update((i, first, len(ids)) for i in ids)
    found = near.classes(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in found) == want
    assert sum(r.kept for r in found) == len(set(parent))
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(parent))
    assert near.classes(nothing).count() == 0


@pytest.mark.parametrize("range_rows", [3, 200_000])
def test_shards(docs, nothing, range_rows):
    placed = sharding.shards(docs, ["doc_id"], n=4, range_rows=range_rows).collect()
    assert Counter(r.doc_id for r in placed) == Counter(r[0] for r in rows())
    for s in {r.shard for r in placed}:
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed)))
    total, most = sum(r["size"] for r in placed), max(r["size"] for r in placed)
    assert all(sum(r["size"] for r in placed if r.shard == s) <= total / 4 + most for s in range(4))
    assert total == sum(len((r[1] or "").encode()) + 1 for r in rows())
    again = sharding.shard(docs, n=4)
    assert again.columns == [*docs.columns, "shard", "slot"] and again.count() == len(rows())
    assert sharding.shards(nothing, ["doc_id"]).count() == 0


def test_containment(spark, docs, nothing):
    data = rows()
    item = " ".join(data[0][1].split()[10:40])
    short = [(4, "word"), (5, "apache word"), (6, data[9][1].split()[4000]), (7, " ".join(data[0][1].split()[50:53])), (8, " ".join(data[0][1].split()[117:])), (9, "under the MIT license")]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), *short, (None, data[11][1][:150])], "item_id long, text string")

    def grams(t, k):
        w = re.findall(r"\w+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want, bad = Counter(), set()
    for i, t in {(r[0], r[1]) for r in bench.collect()}:
        k = min(5, len(re.findall(r"\w+", t or "")))
        q = grams(t, k) if k else set()
        for r in data:
            shared = len(q & grams(r[1], k)) if k else 0
            if q and shared >= 0.8 * len(q):
                want[r[0], i, shared, len(q)] += 1
                bad.add(r[1])
    got = contamination.matches(docs, bench)
    assert Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()) == want
    assert {i for _, i, *_ in want} == {1, 4, 6, 7, 8, 9, None}
    clean = contamination.decontaminated(docs, bench)
    assert clean.columns == docs.columns and Counter(r[:2] for r in clean.collect()) == Counter(r[:2] for r in data if r[1] not in bad)
    assert contamination.matches(nothing, bench).count() == 0 and contamination.matches(docs, bench.where("false")).count() == 0


def test_short_items_in_very_long_texts(spark):
    """Items of one to eight words, each once in a text longer than a stride of the search."""
    rng = random.Random(12)
    long = [f"w{rng.randrange(10**6)}" for _ in range(2 * contamination.STRIDE + 100)]
    at = [0, 7, 4999, contamination.STRIDE - 2, contamination.STRIDE + 5, 100_000, len(long) - 6, len(long) - 8]
    items = [(n, " ".join(long[i : i + n])) for n, i in enumerate(at, 1) if i + n <= len(long)]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:6])), (3, "")], "doc_id long, text string")
    got = contamination.matches(docs, spark.createDataFrame(items, "item_id int, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert {i for d, i in found if d == 1} == {n for n, _ in items} and {i for d, i in found if d == 2} == {1}


def test_benchmark_is_searched_once_for_each_task(docs):
    bench = docs.select(docs.doc_id.alias("item_id"), "text").where("doc_id < 3")
    plan = contamination.matches(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1


def test_long_texts_are_searched_in_pieces():
    words = [f"w{n}" for n in range(contamination.STRIDE)]
    items, text = contamination.Items(["w70", " ".join(words[9:40])]), " ".join(words)
    items.contained(text, 0.8)  # the words' hashes are remembered
    tracemalloc.start()
    found = items.contained(text, 0.8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 1, 1), (1, 27, 27)] and most < 60 << 20


def test_suffix_arrays():
    rng = random.Random(5)
    for n in range(300):
        s = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(n % 50)]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
        best = [max((k for j in range(len(s)) if j != i for k in range(len(s)) if s[i : i + k] == s[j : j + k] and k <= len(s) - max(i, j)), default=0) for i in range(len(s))] if len(s) < 12 else None
        assert best is None or longest_repeats(s).tolist() == best


@pytest.mark.parametrize("frequent", [2, repeats.FREQUENT])
def test_repeats(docs, nothing, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    data = [(r[1] or "").encode() for r in rows()]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    want = Counter()
    for r, b in zip(rows(), data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            gone[i : i + 200] |= seen[b[i : i + 200]] > 1
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want[r[0], len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in repeats.remove(docs).collect()) == want
    assert repeats.remove(nothing).count() == 0


def test_trees(spark, docs, nothing):
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality.NAMES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    model = quality.fit(x, y)
    p = model.probability(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.95

    def walk(row):
        total = model.start
        for f, a, leaf in zip(model.feature, model.above, model.leaf):
            i = 0
            while i < len(f):
                i = 2 * i + 1 + int(row[f[i]] > a[i])
            total += leaf[i - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(p[:50], [walk(r) for r in x[:50]])
    labels = spark.createDataFrame([(0, 1), (0, None), (9, 0), (None, 1)], "doc_id long, quality int")
    learnt = quality.train(docs, labels, F.lit(True))
    scored = quality.score(docs, learnt)
    assert scored.columns == [*docs.columns, "score"] and all(0 <= r.score <= 1 for r in scored.collect())
    assert quality.score(nothing, quality.train(nothing, labels, F.lit(True))).count() == 0


def test_licenses(docs, nothing):
    got = Counter(tuple(r)[:6] for r in licenses.scan(docs).collect())
    want = Counter()
    for r in rows():
        w = re.findall(licenses.WORD, plain(r[1]))
        at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        want[r[0], len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert got == want
    assert {r.labels for r in licenses.scan(docs).collect()} == {"", "cc-by-nc,mit", "gpl-3"}
    assert licenses.scan(nothing).count() == 0


def test_license_passage_with_changes(spark):
    passage = next(p for p, label in licenses.PASSAGES.items() if label == "bsd").split()
    passage.insert(11, "extra")
    found = licenses.scan(spark.createDataFrame([(1, " ".join(["so", *passage, "end"]))], "doc_id long, text string")).first()
    assert found.labels == "bsd" and found.n_base == 0 and 0.8 <= found.score < 1


def test_license_grams_without_their_passage(spark):
    """Every gram of a passage in its order, but with foreign words between, is not the passage."""
    passage = next(p for p, label in licenses.PASSAGES.items() if label == "mpl-2").split()
    apart = [x for i in range(len(passage) - 2) for x in [*passage[i : i + 3], f"foreign{i}"]]
    halves = passage[10:] + passage[:10]
    texts = [" ".join(apart), " ".join(passage), " ".join([*apart, *passage, *apart]), " ".join(halves), " ".join(["so"] * 900 + passage)]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == {0: ("", 0.0), 1: ("mpl-2", 1.0), 2: ("mpl-2", 1.0), 3: ("", 0.0), 4: ("mpl-2", 1.0)}


def test_license_spans_by_brute_force(spark):
    """Passages with words put in, left out and exchanged, against a search of all bands of diagonals."""
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        w = rng.choice(list(licenses.PASSAGES)).split()
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = rng.choice([[], ["new"], ["new", "words"], w[i : i + 3]])
        texts.append(" ".join([*words(rng, 5).split(), *w, *rng.choice([[], w[:12]])]))
    want = {}
    for d, t in enumerate(texts):
        w, labels, score = t.split(), set(), 0.0
        at = {}
        for i in range(len(w) - 2):
            at.setdefault(tuple(w[i : i + 3]), []).append(i)
        for p, label in licenses.PASSAGES.items():
            p = p.split()
            met = [(i - j, j) for j in range(len(p) - 2) for i in at.get(tuple(p[j : j + 3]), [])]
            best = max((len({j for x, j in met if d0 <= x <= d0 + max(3, len(p) // 4)}) for d0, _ in met), default=0) / (len(p) - 2)
            if best >= 0.8:
                labels.add(label)
                score = max(score, best)
        want[d] = (",".join(sorted(labels)), score)
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), base={"zz zz zz": "none"}).collect()
    assert {r.doc_id: (r.labels, r.score) for r in found} == want and 10 < sum(x[1] > 0 for x in want.values()) < 60


def test_targets(spark):
    sizes = [("a", 100), ("b", 10), ("c", 5), (None, 885)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    want, left, total = {}, {s: w for (s, _), w in zip(sizes, (1, 2, 3, 1))}, 1000.0
    while True:  # limits one after the other
        share = total / sum(left.values())
        over = [s for s in left if share * left[s] > 3 * dict(sizes)[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * dict(sizes)[s]
            total -= want[s]
            del left[s]
    want |= {s: share * w for s, w in left.items()}
    assert got == pytest.approx(want)


def test_mixing(docs, nothing):
    mixed = mixing.copies(docs, ["doc_id"]).collect()
    assert Counter((r.doc_id, r["size"]) for r in mixed) == Counter((r[0], len((r[1] or "").split())) for r in rows())
    assert all(0 <= r.copies <= 3 for r in mixed)
    assert Counter(tuple(r) for r in mixing.copies(docs.repartition(5), ["doc_id"]).collect()) == Counter(tuple(r) for r in mixed)
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == sum(r.copies for r in mixed)
    assert mixing.mix(nothing).count() == 0


def test_mixing_of_tied_rows_does_not_depend_on_partitions(spark):
    """Rows of one id and size, a third of them null ids: the same ones are taken however they are dealt."""
    data = [(None if i % 3 else 7, f"{'ab'[i % 2]}{i} word", "s" if i % 5 else None, {"n": i}) for i in range(100)]
    given = spark.createDataFrame(data, "doc_id long, text string, source string, facts map<string,int>")
    once, again = (Counter((r.doc_id, r.text, r.source, r.facts["n"]) for r in mixing.mix(given.repartition(n, "text"), weights=(1, 2)).collect()) for n in (1, 9))
    assert once == again and sum(once.values()) > 50


def test_rows_that_differ_in_maps_stay_apart(spark):
    """Maps on their own, in structs and in arrays, nulls and missing entries: no row takes another's place."""
    from wordloom.llm.common import attach, row_key

    schema = "doc_id long, m map<string,int>, s struct<n:int,m:map<int,string>>, a array<map<string,timestamp>>"
    import datetime as dt

    when = dt.datetime(2020, 1, 1, 0, 0, 0, 1)
    data = [(1, {"a": 1}, None, None), (1, {"a": 2}, None, None), (1, {"a": None}, None, None), (1, {}, None, None), (1, None, None, None)]
    data += [(1, None, (1, {1: "x"}), None), (1, None, (1, {2: "x"}), None), (1, None, (None, None), None), (1, None, None, [{}])]
    data += [(1, None, None, [{"t": when}]), (1, None, None, [{"t": when.replace(microsecond=2)}]), (1, None, None, [])]
    df = spark.createDataFrame(data, schema)
    keyed = df.select(row_key(df).alias("_row"))
    assert keyed.distinct().count() == len(data)
    assert Counter(map(repr, attach(df.union(df), keyed).collect())) == Counter(map(repr, df.collect()))


def test_tokens(docs, nothing):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter((r[0], len(encoder.encode(r[1] or "", add_special_tokens=False))) for r in rows())
    counted = tokens.count_tokens(docs, P.path("byte_bpe_50k.json"))
    assert Counter((r.doc_id, r.n_tokens) for r in counted.collect()) == want
    assert tokens.count_tokens(nothing, P.path("byte_bpe_50k.json")).count() == 0
    rng = random.Random(2)
    counter = tokens._Counter(P.path("byte_bpe_50k.json"))
    odd = ["".join(rng.choice("ab'1 .\n\té s") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert counter.lengths(odd) == [len(e) for e in encoder.encode_batch(odd, add_special_tokens=False)]
    # Texts beyond a batch, pieces beyond a block, and a worker that has to forget.
    assert list(tokens.batches_of(["ab", "ä", "", "c"], 4)) == [["ab", "ä"], ["", "c"]]
    long = ["wörd " * 300_000, "x" * 50_000, "".join(chr(0x4E00 + i % 900) for i in range(40_000)), *(f"w{i} v{i}" for i in range(500))]
    expected = [len(e) for e in encoder.encode_batch(long, add_special_tokens=False)]
    for _ in range(2):
        assert [n for texts in tokens.batches_of(long, tokens.BATCH_BYTES) for n in counter.lengths(texts)] == expected
        counter.size = tokens.REMEMBERED + 1


def test_language(spark, docs, nothing):
    rng = random.Random(4)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40))
    data = [(i, make("abcdef" if i % 2 else "uvwxyé"), "ab"[i % 2]) for i in range(80)]
    labelled = spark.createDataFrame(data, "doc_id long, text string, lang string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.train(labelled, ~held)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(labelled, model).collect()}
    x = language.presence([t for _, t, _ in data])
    direct = language.kernel(x, model.marks.astype(np.float32)) @ model.weights[:-1] + model.weights[-1]
    for (i, _, lang), o in zip(data, direct):
        assert got[i][0] == model.languages[int(o.argmax())]
        assert zlib.crc32(str(i).encode()) % 4 != 2 or got[i][0] == lang
    odd = language.predict(docs, model)
    assert {r.doc_id for r in odd.collect() if r.lang_pred == "und"} == {3, 4, 5, 6, None}
    assert all(0 <= r.score <= 1 for r in odd.collect())
    none = language.train(nothing, F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_group_weights_bound_the_similarity():
    rng = np.random.default_rng(4)
    weights = near.idf(np.ones(near.DF_SLOTS + 1, np.int64))
    base = [f"w{i}" for i in rng.integers(0, 400, 300)]
    texts = [" ".join(base[:at] + [f"x{at}", f"y{at}"] + base[at + gap :]) for at, gap in zip(rng.integers(0, 300, 60), rng.integers(0, 60, 60))]
    texts += ["w1 w2", "w1 w2 w3 w4 w5 " * 40, "w1 w2 w3 w4 w5 " * 41]
    vectors = [near.weighted(t, weights) for t in texts]
    rule, totals = near.link_rule(0.8), np.array([near._total(w) for _, w in vectors])
    tree = rtree.Tree(np.stack([near.group_weights(h, w, 128) for h, w in vectors]), totals, rule)
    for i, v in enumerate(vectors):
        links = {j for j, u in enumerate(vectors) if near.similarity(v, u) >= 0.8}
        assert links <= set(tree.near(i).tolist())


def test_near_links_of_a_large_group_in_small_pages(spark, monkeypatch):
    """Copies around the threshold: pages of a few texts lose no link of those that share a band."""
    rng = random.Random(8)
    base = words(rng, 120).split()
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    v = [near.weighted(t, near.idf(near.document_frequencies(df))) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or near.similarity(v[i], v[j]) >= 0.8:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    want = sorted(enumerate(label))
    for page in (near.PAGE, 8):
        monkeypatch.setattr(near, "PAGE", page)
        assert sorted((r.doc_id, r.class_id) for r in near.classes(df).collect()) == want
