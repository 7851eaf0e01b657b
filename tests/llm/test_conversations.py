"""Conversation repair against a search over whole audits, and the cases its docstring states."""

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wordloom.llm import conversations as C
from wordloom.llm.queries import op13_conversation_repair

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
THEN = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def outcome(rows, audit):
    """(cost, lines) of an audit over (role, text, fault), None if it is not allowed."""
    state, at, cost, lines = "", 0, 0, []
    for edit in audit:
        if edit == "I":
            cost, role, text = cost + 5, THEN[state], ""
        else:
            if at == len(rows):
                return None
            role, text, fault = rows[at]
            at += 1
            if edit == "D":
                cost += 2
                continue
            if fault in ("blank", "duplicate"):
                return None
            cost += 5 * (fault == "truncated")
            if edit == "R":
                cost, role = cost + 1, THEN[state]
            elif not (role[:1] == "s" and not state) and role[:1] != THEN[state][0]:
                return None
        state = role[0]
        lines.append(f"{role}:{text}")
    return (cost, lines) if at == len(rows) and state in ("", "a") else None


def best(rows):
    """By the cheapest audit to each state; no audit of as many rows begins another."""
    kept = {"": (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(3):
            for state, (cost, audit) in list(kept.items()):
                kept[THEN[state][0]] = min(kept.get(THEN[state][0], (cost + 5, audit + "I")), (cost + 5, audit + "I"))
        if i == len(rows):
            break
        role, _, fault = rows[i]
        fresh = {}
        for state, (cost, audit) in kept.items():
            offers = [(state, cost + 2, "D")]
            if fault not in ("blank", "duplicate"):
                cost += 5 * (fault == "truncated")
                offers.append((THEN[state][0], cost + 1, "R"))
                if role[:1] and ((role[0] == "s" and not state) or role[0] == THEN[state][0]):
                    offers.append((role[0], cost, "K"))
            for to, price, edit in offers:
                fresh[to] = min(fresh.get(to, (price, audit + edit)), (price, audit + edit))
        kept = fresh
    return min(v for s, v in kept.items() if s in ("", "a"))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def expected(rows):
    """Of rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    found = faults(rows)
    told = [(r, t, f) for (_, r, t), f in zip(rows, found)]
    cost, audit = best(told)
    again, lines = outcome(told, audit)
    assert again == cost
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
        "cost": cost,
        "audit": audit,
        "sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def repaired(df):
    found = C.repair(df)
    rows = found.conversations.join(C.digests(found.lines), "conv", "left")
    rows = rows.withColumn("sha256", F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return {r["conv_id"]: r.asDict() for r in rows.collect()}


def check(df):
    by = {}
    for r in df.collect():
        space = lambda v: " " if v is None else v
        by.setdefault(r.conv_id, []).append((r.turn, space(r.role), space(r.text)))
    got = repaired(df)
    assert got.keys() == by.keys()
    for conv, rows in by.items():
        want = expected(rows)
        assert {k: got[conv][k] for k in want} == want, conv


def test_best_is_the_least_of_all_audits():
    kinds = list(itertools.product(["system", "user", "assistant", "x", ""], ["", "blank", "truncated"]))
    random.seed(5)
    for n in range(4):
        for _ in range(12):
            rows = [(r, "t.", f) for r, f in random.choices(kinds, k=n)]
            audits = {"".join(a) for size in range(n + 3) for a in itertools.product("DIKR", repeat=size)}
            costs = [(o[0], a) for a in audits if (o := outcome(rows, a))]
            assert min(costs) == best(rows)


def test_registered_query(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    by = {}
    for r in given.collect():
        h = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", r.text) if h == 2 else r.text
        by.setdefault(r.conv_id, []).extend([(r.turn, "user" if h == 4 else r.role, text)] * (0 if h == 0 else 2 if h == 3 else 1))
    got = {r.conv_id: r.asDict() for r in op13_conversation_repair(spark, FOLDER).collect()}
    assert got.keys() == by.keys()
    for conv, rows in by.items():
        want = expected(rows)
        want["repaired_sha256"] = want.pop("sha256")
        assert got[conv] == {"conv_id": conv, **want}


def test_random_rows_with_ties_nulls_and_a_long_conversation(spark):
    random.seed(11)
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["a.", "b", " ", "", None, "c?\t", "d!", "é. \n"]
    rows = [(random.choice([1, 2, 3, None]), random.choice([None, 0, 1, 2, 3, 9]), random.choice(roles), random.choice(texts)) for _ in range(200)]
    rows += [(7, n // 2, random.choice(roles), f"{n % 700}{random.choice('.!?x')}") for n in range(3000)]
    rows += [(8, None, "user", "again.")] * 600
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'y' AS conv", "1 AS at", "2 AS _tied")
    check(df)


def test_very_long_texts_and_no_rows(spark):
    check(spark.createDataFrame([(1, 0, "user", "word " * 50_000 + "end."), (1, 1, "assistant", "ü" * 30_000 + "?")], SCHEMA))
    none = C.repair(spark.createDataFrame([], SCHEMA))
    assert none.conversations.count() == 0 and C.digests(none.lines).count() == 0


def test_all_rows_dropped(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "hello.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = op13_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
