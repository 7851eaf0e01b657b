"""From documents to postings, and statistics over postings.

The terms of a document are grouped inside its row, by an Arrow function over
its words (``functions/runs.py``).  A document is one row of the scan, so its
postings need no shuffle, whatever the number of documents or the frequency
of a term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.analysis import drop_stop_words, tokenize
from wordloom.functions.lengths import quantize_length
from wordloom.functions.runs import term_runs

FIELDS = ("content", "title")


def analyze_documents(corpus: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row per document: ``runs_<field>`` next to the other columns.

    The texts themselves are dropped; a narrow step, whatever the corpus size.
    """
    keys = [c for c in corpus.columns if c not in fields]
    runs = [term_runs(tokenize(F.col(f))).alias(f"runs_{f}") for f in fields]
    return corpus.select(*keys, *runs)


def postings_of(analyzed: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """``field, term, doc_id, tf, positions, dl, dl_q, lead``.

    ``dl`` is the number of terms of the field.  ``lead`` marks one posting
    per document and field, which lets documents be counted without a
    distinct.
    """
    per_field = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"runs_{f}").alias("runs")) for f in fields]
    )
    dl = F.aggregate("runs", F.lit(0), lambda n, r: n + r["tf"])
    # Lengths are taken in a step of their own, before the generator: anything
    # computed next to a generator is computed again for every row it makes.
    # The outer form: the inner one would make Spark test the array for
    # emptiness first, and so run the whole analysis twice.
    return (
        analyzed.select("doc_id", F.inline_outer(per_field))
        .select("doc_id", "field", "runs", dl.alias("dl"))
        .select("doc_id", "field", "runs", "dl", quantize_length(F.col("dl")).alias("dl_q"))
        .select("doc_id", "field", "dl", "dl_q", F.posexplode_outer("runs").alias("i", "run"))
        .where(F.col("run").isNotNull())
        .select(
            "field",
            "run.term",
            "doc_id",
            "run.tf",
            "run.positions",
            "dl",
            "dl_q",
            (F.col("i") == 0).alias("lead"),
        )
    )


def build_postings(corpus: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    return postings_of(analyze_documents(corpus.select("doc_id", *fields), fields), fields)


def doc_lengths(postings: DataFrame) -> DataFrame:
    """Fields without a term have no length and are not counted."""
    return postings.where("lead").select("field", "doc_id", "dl", "dl_q")


def text_lengths(corpus: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """``doc_lengths`` from the texts: words that are no stop words are counted, not stemmed."""
    per_field = [
        F.struct(F.lit(f).alias("field"), F.size(F.array_compact(drop_stop_words(tokenize(F.col(f))))).alias("dl")) for f in fields
    ]
    # The outer form, as in ``postings_of``.
    lengths = corpus.select("doc_id", F.inline_outer(F.array(*per_field))).where("dl > 0")
    return lengths.select("field", "doc_id", "dl", quantize_length(F.col("dl")).alias("dl_q"))


def term_dictionary(postings: DataFrame) -> DataFrame:
    """``field, term, df, ttf, lead_docs``: sums, so dictionaries add up.

    ``max_tf`` and ``min_dl_q`` bound what the term can add to a score.
    """
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"),
        F.sum("tf").alias("ttf"),
        F.count_if("lead").alias("lead_docs"),
        F.max("tf").alias("max_tf"),
        F.min("dl_q").alias("min_dl_q"),
    )


def field_statistics(terms: DataFrame) -> DataFrame:
    """``field, doc_count, sum_dl`` from the term dictionary."""
    return terms.groupBy("field").agg(
        F.sum("lead_docs").alias("doc_count"), F.sum("ttf").alias("sum_dl")
    )
