"""Ranking formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
K1 = 1.2
B = 0.75
MODELS = {"ok": "Okapi BM25", "vs": "Vector Space"}

SCORE_DIGITS = 6


def model_key(model: str) -> str:
    key = model.lower()
    if key not in MODELS:
        raise ValueError(f"ranking model must be one of {sorted(MODELS)}, not {model!r}")
    return key


def idf(model: str, df: Column, doc_count: Column) -> Column:
    if model_key(model) == "ok":
        return F.log(1 + (doc_count - df + 0.5) / (df + 0.5))
    return F.log((doc_count + 1) / (df + 1)) + 1


def term_score(model: str, idf_: Column, tf: Column, dl_q: Column, avgdl: Column) -> Column:
    """Score of one term (or phrase) in one field, for a boost of 1."""
    if model_key(model) == "ok":
        return idf_ * tf / (tf + K1 * (1 - B + B * dl_q / avgdl))
    return idf_ * F.sqrt(tf) / F.sqrt(dl_q)
