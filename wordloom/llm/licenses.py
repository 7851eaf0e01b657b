"""License scans by diagonal voting: word k-grams joined to template positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.common import whole, written

K = 3
# Diagonals this far apart belong to one place: words put in or left out.
NEAR = 3
# Part of a template's k-grams that a place must hold.
COVER = 0.8
# A verified span is at most this part of its passage longer, or NEAR words if that is more.
LONGER = 4
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that count word by word, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Longer passages of license texts, found in spite of small changes.
PASSAGES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: str | Column = "text") -> Column:
    return F.regexp_extract_all(F.translate(whole(text), _UPPER, _UPPER.lower()), F.lit(WORD), 0)


def grams(words: Column, k: int = K) -> Column:
    """The rolling k-grams of a word array, as strings; empty if it has fewer than k words."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    joined = F.transform(at, lambda i: F.concat_ws(" ", *(F.get(words, i + j) for j in range(k))))
    return F.when(F.size(words) >= k, joined).otherwise(F.array().cast("array<string>"))


def drift(passage: list[str]) -> int:
    """How far apart the diagonals of one span of the passage may lie."""
    return max(NEAR, len(passage) // LONGER)


def templates(spark: SparkSession, base=BASE, passages=PASSAGES) -> DataFrame:
    """A row for each k-gram of each template: a fixed size."""
    rows = []
    for n, (phrase, label, exact) in enumerate([(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in passages.items()]):
        w = phrase.split()
        rows += [(n, label, exact, len(w) - K + 1, drift(w), i, " ".join(w[i : i + K])) for i in range(len(w) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, n_grams int, drift int, t_at int, t_gram string")


def places(docs: DataFrame, keys: list[str], base=BASE, passages=PASSAGES) -> DataFrame:
    """Where templates stand: ``keys``, label, exact, start (word, from 0), cover (0 to 1).

    All k-grams of all texts meet the template positions in a join on the hash
    of the gram, verified by the gram itself.  A match votes for the diagonal
    position minus template position.  A base phrase stands where one diagonal
    has all its grams.  For a passage, diagonals at most NEAR apart are merged
    to a place, whose span is then verified: diagonals no farther apart than
    the passage's ``drift`` must hold COVER of its grams.  A span is so at most
    that much longer than the passage, and no gram of it stands farther than
    that from its turn.  A place starts where its best span does, the first of
    equals.  Rows equal in ``keys`` count once.  Texts shorter than a gram have
    no place.
    """
    known = templates(docs.sparkSession, base, passages).withColumn("_h", F.xxhash64("t_gram"))
    said = docs.select(*keys, F.posexplode(grams(F.col("_words"))).alias("_at", "_gram"))
    met = said.withColumn("_h", F.xxhash64("_gram")).join(F.broadcast(known), "_h").where("_gram = t_gram")
    template = ["template", "label", "exact", "n_grams", "drift"]
    votes = met.groupBy(*keys, *template, (F.col("_at") - F.col("t_at")).alias("_diagonal")).agg(
        F.collect_set("t_at").alias("_found")  # at most the template's grams
    )
    votes = written(votes)  # few and narrow, used twice: the texts are read once for them
    full = votes.where("exact and size(_found) = n_grams").select(*keys, "template", "label", "exact", F.col("_diagonal").alias("start"), F.lit(1.0).alias("cover"))
    by = Window.partitionBy(*keys, "template").orderBy("_diagonal")
    widest = max((drift(p.split()) for p in passages), default=NEAR)
    # A frame holds at most widest + 1 diagonals.
    ahead = F.collect_list(F.struct("_diagonal", "_found")).over(by.rangeBetween(0, widest))
    span = F.filter(ahead, lambda v: v["_diagonal"] <= F.col("_diagonal") + F.col("drift"))
    held = F.size(F.array_distinct(F.flatten(F.transform(span, lambda v: v["_found"]))))
    parted = votes.where("not exact").withColumn("_held", held).withColumn("_new", (F.col("_diagonal") - F.lag("_diagonal", 1, -1_000_000).over(by) > NEAR).cast("int"))
    merged = parted.withColumn("_place", F.sum("_new").over(by)).groupBy(*keys, *template, "_place").agg(
        F.max(F.struct("_held", (-F.col("_diagonal")).alias("_first"))).alias("_best")
    )
    verified = merged.withColumn("cover", F.col("_best._held") / F.col("n_grams")).where(F.col("cover") >= COVER)
    near = verified.select(*keys, "template", "label", "exact", F.greatest(-F.col("_best._first"), F.lit(0)).alias("start"), "cover")
    return full.unionByName(near)


def scan(docs: DataFrame, base=BASE, passages=PASSAGES) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest cover of a place, 0 without any.  Labels are
    distinct, sorted and joined by commas, empty where there is none.  A null
    text is empty.  Places are looked up by id and text, so repeated rows, and
    rows that share an id, have their own text's result.
    """
    keyed = docs.select("doc_id", F.xxhash64(whole("text"), F.col("doc_id").isNull()).alias("_t"), F.coalesce("doc_id", F.lit(0)).alias("_d"), words().alias("_words"))
    found = places(keyed, ["_d", "_t"], base, passages)
    exact = F.col("exact")
    summed = found.groupBy("_d", "_t").agg(
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    rows = keyed.select("doc_id", "_d", "_t", F.size("_words").cast("long").alias("n_words"))
    return rows.join(summed, ["_d", "_t"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
