"""The registered queries of the operators, thin around them, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.llm import contamination, conversations, exact, language, licenses, mixing, near, overlap, quality, ranking, repeats, sharding, tokens
from wordloom.llm.common import load, remainder, whole


def op1_exact_dedup(spark, sf):
    return exact.deduplicate(load(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_near_dedup(spark, sf):
    return near.classes(load(spark, sf, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op3_sharding(spark, sf):
    docs = load(spark, sf, "documents")
    rows = docs.withColumn("text_crc32", F.crc32(whole("text").cast("binary")))
    placed = sharding.shards(rows, ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_decontamination(spark, sf):
    return contamination.matches(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


def op5_repeats(spark, sf):
    return repeats.remove(load(spark, sf, "documents")).drop("kept")


def op6_quality(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 5) == 0
    model = quality.train(docs, load(spark, sf, "labels"), ~held_out)
    scored = quality.score(docs, model).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_licenses(spark, sf):
    return licenses.scan(load(spark, sf, "documents"))


def op8_mixing(spark, sf):
    mixed = mixing.copies(load(spark, sf, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_token_counts(spark, sf):
    import public_tokenizers

    docs = load(spark, sf, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", F.octet_length(whole("text")).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op10_language(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = language.train(docs, ~held_out)
    told = language.predict(docs.select("doc_id", "text"), model).withColumn("held_out", held_out)
    return told.select("doc_id", "held_out", "lang_pred", "score")


def op11_shingle_join(spark, sf):
    return overlap.linked(load(spark, sf, "documents"))


def op12_ranked_search(spark, sf):
    found = ranking.rank(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op13_conversation_repair(spark, sf):
    given = load(spark, sf, "conversations")
    fixed = conversations.repair(conversations.damage(given))
    ids = given.select("conv_id", conversations._conv().alias("conv")).distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    found = ids.join(fixed.conversations.drop("conv_id"), "conv", "left").join(conversations.digests(fixed.lines), "conv", "left")
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def queries():
    named = (op1_exact_dedup, op2_near_dedup, op3_sharding, op4_decontamination, op5_repeats, op6_quality, op7_licenses, op8_mixing, op9_token_counts, op10_language, op11_shingle_join, op12_ranked_search, op13_conversation_repair)
    return {f.__name__: f for f in named}
