"""Quality scores: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import whole

# Labelled rows learnt from, at most.
LEARN_MOST = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAF_LEAST = 8
SMOOTH = 1.0
BLOCK = 512

_MARKS = np.frombuffer(b"!#$%&*|?@^~<>{}[]()_=+/;:'-", np.uint8)
NAMES = (
    "log_bytes", "letters", "upper", "digits", "spaces", "marks", "above_ascii", "controls", "full_stops", "commas",
    "top_mark", "log_words", "word_length", "distinct_words", "distinct_pairs", "top_word", "log_lines",
    "distinct_lines", "line_length", "longest_word", "ends_in_mark", "words_in_repeated_lines", "entropy", "urls",
)


def statistics(text: str) -> list[float]:
    """The inputs of the trees for one whole text; zeros for an empty one."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = len(data)
    if not n:
        return [0.0] * len(NAMES)
    c = np.bincount(data, minlength=256)
    p = c[c > 0] / n
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    m, k = max(1, len(words)), max(1, len(lines))
    codes = pd.factorize(np.array(words, dtype=object))[0] if words else np.zeros(0, np.int64)
    per_word = np.bincount(codes) if len(codes) else np.zeros(1, np.int64)
    pairs = len(np.unique(codes[:-1].astype(np.int64) * len(per_word) + codes[1:])) if len(codes) > 1 else 1
    per_line: dict[str, int] = {}
    for x in lines:
        per_line[x] = per_line.get(x, 0) + 1
    repeated = sum(len(x) * r for x, r in per_line.items() if r > 1)
    ends = sum(1 for w in words if not w[-1].isalnum())
    return [
        np.log1p(n), (c[65:91].sum() + c[97:123].sum()) / n, c[65:91].sum() / n, c[48:58].sum() / n,
        (c[32] + c[9:14].sum()) / n, c[_MARKS].sum() / n, c[128:].sum() / n, c[:9].sum() / n, c[46] / n, c[44] / n,
        c[_MARKS].max() / n, np.log1p(len(words)), n / m, len(per_word) / m, pairs / m, per_word.max() / m,
        np.log1p(len(lines)), len(per_line) / k, n / k, np.log1p(max(map(len, words), default=0)), ends / m,
        repeated / n, float(-(p * np.log2(p)).sum()), text.count("http") / m,
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(NAMES))


@dataclass
class Trees:
    """Full binary trees as arrays: node i has children 2i+1 and 2i+2, and leaves hold steps."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    above: np.ndarray  # goes right if the value is above this
    leaf: np.ndarray  # trees x leaves

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Scores of all rows in all trees at once, one step down a time."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0):
            value = np.take_along_axis(x, self.feature[trees, at], axis=1)
            at = 2 * at + 1 + (value > self.above[trees, at])
        total = self.start + (self.leaf[trees, at - self.feature.shape[1]].sum(1) if len(self.feature) else np.zeros(len(x)))
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boost depth-wise trees on logistic loss; splits come from histograms of binned values.

    Without rows, or with one label only, there are no trees and the score is constant.
    """
    inner, leaves = 2**depth - 1, 2**depth
    none = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return Trees(0.0 if not len(y) else (4.0 if y[0] else -4.0), *none)
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for col in x.T]
    binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)], axis=1)
    f, size = x.shape[1], BINS
    flat = binned + np.arange(f)[None, :] * size
    start = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(len(y), start)
    feature, above, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)  # within its level
        for level in range(depth):
            width = 2**level
            slots = (node[:, None] * (f * size) + flat).ravel()
            shape = (width, f, size)
            sums = [np.bincount(slots, np.repeat(v, f), width * f * size).reshape(shape) for v in (g, h, np.ones(len(y)))]
            gl, hl, nl = (s.cumsum(2)[:, :, :-1] for s in sums)
            gt, ht, nt = (s.sum(2)[:, :, None] for s in sums)
            gain = gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH) - gt**2 / (ht + SMOOTH)
            gain[(nl < LEAF_LEAST) | (nt - nl < LEAF_LEAST)] = -1
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), size - 1)
                if gain[k].flat[best[k]] > 1e-9 and b < len(edges[j]):
                    feature[t, width - 1 + k], above[t, width - 1 + k] = j, edges[j][b]
            at = width - 1 + node
            node = 2 * node + (x[np.arange(len(y)), feature[t, at]] > above[t, at])
        steps = rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + SMOOTH)
        leaf[t] = steps
        raw += steps[node]
    return Trees(start, feature, above, leaf)


def train(docs: DataFrame, labels: DataFrame, learn: Column, most: int = LEARN_MOST) -> Trees:
    """Fit on at most ``most`` labelled documents where ``learn`` (on doc_id) holds.

    ``labels`` has doc_id and quality; null labels do not count, and of several
    for one document the mean decides.  Those with the smallest hash of the id
    are taken.  The driver gets their statistics, a fixed size each.
    """
    told = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learn)
    told = told.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("_label"))
    told = F.broadcast(told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))  # at most `most` rows

    @F.pandas_udf("array<double>")
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(t) for t in batch])

    rows = docs.select("doc_id", "text").join(told, "doc_id").select("doc_id", "_label", stats(whole("text")).alias("x")).limit(2 * most).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(NAMES))
    return fit(x, np.array([r["_label"] for r in rows]))


def score(docs: DataFrame, model: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the chance of label 1 by the whole text, null and empty texts as one without words.

    Every row, repeated or without id, has its own score; a column named
    ``out`` is replaced.  Blocks of statistics go through all trees at once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # trees: a fixed size

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = Trees(**sent.value)
        for batch in batches:
            parts = [trees.probability(matrix(batch.iloc[i : i + BLOCK])) for i in range(0, len(batch), BLOCK)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out, scored(whole(text)))
