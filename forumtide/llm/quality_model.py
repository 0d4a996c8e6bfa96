"""Quality classifier: histogram gradient-boosted trees over document statistics.

Workers turn each whole text into a fixed list of statistics. The trees are fitted on the
statistics of a bounded sample of labelled documents (``SAMPLE_ROWS``, a parameter; the
sample is drawn by a hash of the id and only numbers reach the driver), then flattened into
arrays over complete binary trees, which every worker walks for a whole batch at once.

Defined results: a null or empty text has all statistics 0 and is scored like any other.
Labels with a null id or value are left out; several labels of one id are averaged. Without
labels every score is 0.5. Rows with a null doc_id are scored and not held out. Repeated rows
give repeated scores. Only doc_id and text of the documents are read by ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 40_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
SHRINK = 1.0
MIN_WEIGHT = 3.0
THRESHOLD = 0.3

SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
FEATURES = (
    "log_words", "word_length", "longest_word", "distinct_words", "stutter", "distinct_pairs",
    "log_lines", "line_words", "repeated_lines", "upper", "lower", "digits", "blanks",
    "symbols", "bars", "bangs", "stops", "commas", "other_punctuation", "beyond_ascii",
    "byte_entropy", "symbols_per_word", "bangs_per_word", "short_words",
)


def statistics(text: str) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = len(raw)
    words = raw.split()
    n = max(1, len(words))
    lengths = list(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    share = count[count > 0] / size
    upper, lower, digits = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    blanks = count[9:14].sum() + count[32]
    symbols = count[SYMBOLS].sum()
    punctuation = size - upper - lower - digits - blanks - count[128:].sum()
    return [
        float(np.log1p(len(words))), sum(lengths) / n, float(max(lengths, default=0)),
        len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / n, float(np.log1p(len(lines))),
        len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        upper / size, lower / size, digits / size, blanks / size, symbols / size,
        count[124] / size, count[33] / size, count[46] / size, count[44] / size,
        punctuation / size, count[128:].sum() / size, float(-(share * np.log2(share)).sum()),
        symbols / n, count[33] / n, sum(length <= 3 for length in lengths) / n,
    ]


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(text or "") for text in texts], dtype=np.float64).reshape(
        -1, len(FEATURES)
    )


def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series(list(matrix(texts)), dtype=object)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of equal depth as flat arrays; child of i is 2 i + 1 or 2 i + 2."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray      # trees x inner nodes: go right above it
    leaf: np.ndarray     # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees for the logistic loss, grown level by level from histograms."""
    inner = (1 << DEPTH) - 1
    empty = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(y):
        return Trees(0.0, *empty)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    cuts = [
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
        for f in range(x.shape[1])
    ]
    binned = np.stack(
        [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1
    )
    total = np.full(len(y), start)
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature = np.zeros(inner, np.int64)
        limit = np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            place = node - first
            best = np.full(width, 1e-9)
            split = np.full(width, BINS)
            for f, c in enumerate(cuts):
                slot = place * (BINS + 1) + binned[:, f]
                shape = (width, BINS + 1)
                g = np.bincount(slot, gradient, width * (BINS + 1)).reshape(shape).cumsum(1)
                h = np.bincount(slot, weight, width * (BINS + 1)).reshape(shape).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + SHRINK) + (g_all - g) ** 2 / (h_all - h + SHRINK)
                    - g_all**2 / (h_all + SHRINK)
                )
                gain[(h < MIN_WEIGHT) | (h_all - h < MIN_WEIGHT)] = 0
                gain = gain[:, :len(c)]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], split[k] = top[k], at[k]
                    feature[first + k], limit[first + k] = f, c[at[k]]
            chosen = feature[node]
            right = binned[np.arange(len(y)), chosen] > split[place]
            node = 2 * node + 1 + right
        place = node - inner
        g = np.bincount(place, gradient, inner + 1)
        h = np.bincount(place, weight, inner + 1)
        leaf = RATE * g / (h + SHRINK)
        total = total + leaf[place]
        features.append(feature)
        limits.append(limit)
        leaves.append(leaf)
    return Trees(start, np.array(features), np.array(limits), np.array(leaves))


def held_out(doc_id: Column) -> Column:
    """Every fifth document by check sum of its id is kept out of the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on a hashed sample of about ``sample_rows`` labelled documents. This runs jobs.

    The sampled labels are broadcast: their number is bounded by the parameter.
    """
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("_ft_label"))
    n = known.count()
    if n > sample_rows:
        part = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20))
        known = known.where(part < int((1 << 20) * sample_rows / n))
    measured = F.pandas_udf(_statistics, "array<double>")
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
        .select("doc_id", "_ft_label", measured("text").alias("_ft_x"))
        .toPandas()
    )
    # Fixed order: sums of floats, and so the trees, do not depend on the tasks' order.
    rows = rows.assign(_ft_key=[tuple(x) for x in rows["_ft_x"]]).sort_values(
        ["doc_id", "_ft_key"], kind="stable"
    )
    x = np.array(rows["_ft_x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, rows["_ft_label"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(trees.score(matrix(batch)))

    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
