"""Language ID: string kernels with Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import whole

# Slots for the presence of byte n-grams of 1, 2 and 3.
SLOTS = 1 << 13
# Labelled texts learnt from: at most so many of a language, and of all.
PER_LANGUAGE = 500
LEARN_MOST = 4_000
LANDMARKS = 160
RIDGE = 1e-2
BLOCK = 128
NONE = "und"


def presence(texts: list[str]) -> np.ndarray:
    """Which n-grams of the lower-cased whole texts there are, by slot: 0 or 1, a row a text."""
    out = np.zeros((len(texts), SLOTS), dtype=np.float32)
    for row, text in zip(out, texts):
        one = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
        row[one] = 1  # the first slots hold single bytes as they are
        gram = one
        for n in (2, 3):
            if len(one) >= n:
                gram = (gram[:-1] << np.uint32(8)) | one[n - 1 :]
                slot = ((gram * np.uint32(2654435761)) ^ np.uint32(0x9E3779B1 + n)) * np.uint32(2246822519)
                row[(slot >> np.uint32(8)) % np.uint32(SLOTS - 256) + np.uint32(256)] = 1
    return out


def kernel(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Shared n-grams over the geometric mean of both texts' own."""
    a = np.sqrt(np.maximum(x.sum(1), 1))
    b = np.sqrt(np.maximum(marks.sum(1), 1))
    return (x @ marks.T) / a[:, None] / b[None, :]


@dataclass
class LanguageModel:
    languages: list[str]
    marks: np.ndarray
    weights: np.ndarray

    def outputs(self, texts: list[str]) -> np.ndarray:
        return kernel(presence(texts), self.marks.astype(np.float32)) @ self.weights


def fit(x: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """One ridge regression a language on Nyström features of the presence rows."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], np.zeros((0, SLOTS), np.uint8), np.zeros((0, 0), np.float32))
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Landmarks take the languages in turn, so that a rare one has its share.
    turns: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        turns.setdefault(lang, []).append(i)
    order = sorted((k, lang, i) for lang, rows in turns.items() for k, i in enumerate(rows))
    marks = x[[i for _, _, i in order[:landmarks]]]
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = np.hstack([kernel(x, marks) @ root, np.ones((len(x), 1))])
    # Each language weighs the same, however many texts it has.
    w = np.array([1.0 / len(turns[lang]) for lang in langs])[:, None]
    w = w / w.mean()
    solved = np.linalg.solve(z.T @ (z * w) + ridge * np.eye(z.shape[1]), z.T @ (y * w))
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    return LanguageModel(names, marks.astype(np.uint8), weights.astype(np.float32))


def train(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, most: int = LEARN_MOST) -> LanguageModel:
    """Fit on a bounded sample of the rows where ``learn`` holds: per_language, and ``most`` in all.

    The rows of a language with the smallest hash of the id are taken; tasks
    keep only their best before anything moves.  What reaches the driver are
    presence bits, a fixed size a row.
    """
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    keys = usable.select(F.xxhash64("doc_id").alias("_h"), "doc_id", "lang")
    best = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))
    ids = keys.withColumn("_n", best).where(F.col("_n") <= per_language).orderBy("_n", "_h").limit(most)
    ids = F.broadcast(ids.select("doc_id", "lang").distinct())  # at most `most` rows

    @F.pandas_udf("binary")
    def bits(texts: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(presence([t])[0].astype(bool)).tobytes() for t in texts])

    rows = usable.join(ids, ["doc_id", "lang"]).select("doc_id", "lang", bits("text").alias("bits")).limit(2 * most).collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["bits"]))
    x = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in rows], dtype=np.float32).reshape(-1, SLOTS)
    return fit(x, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with ``lang_pred`` and ``score`` (0 to 1) from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if the model has learnt no language.  Equal outputs go to the
    first language by code point.  Columns of these names are replaced; every
    row, repeated or without id, has its own result.  A block of texts meets
    the landmarks in one matrix product.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # landmarks: a fixed size

    @F.pandas_udf("lang string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = LanguageModel(**sent.value)
        model = LanguageModel(m.languages, m.marks.astype(np.float32), m.weights[:-1] if len(m.weights) else m.weights)
        for batch in batches:
            langs, scores = [NONE] * len(batch), np.zeros(len(batch))
            told = [i for i, t in enumerate(batch) if model.languages and any(map(str.isalpha, t))]
            for start in range(0, len(told), BLOCK):
                rows = told[start : start + BLOCK]
                out = model.outputs([batch.iat[i] for i in rows]) + m.weights[-1]
                for i, best, value in zip(rows, out.argmax(1), out.max(1)):
                    langs[i], scores[i] = model.languages[best], min(1.0, max(0.0, (1 + float(value)) / 2))
            yield pd.DataFrame({"lang": langs, "score": scores})

    # Its own stage: else the struct would be computed once for each field.
    both = docs.drop("lang_pred", "score").withColumn("_told", scored(whole(text)))
    return both.withColumns({"lang_pred": F.col("_told.lang"), "score": F.col("_told.score")}).drop("_told")
