"""Quality classifier: regularised quadratic discriminant analysis.

Each whole text becomes a vector of transformed document statistics (logs of
lengths and of smoothed shares). Per class (quality 0 / 1) the mean and the
covariance come from sums that Spark gathers over all training rows; each
class covariance is shrunk towards the pooled one and a ridge is added. The
score is the logistic of the difference of the two Mahalanobis log densities
plus the log prior odds; the classes' Cholesky factors are computed once and
sent to the tasks with the scoring function.

Defined results: null text counts as empty and is scored like any text.
Labels of a document that repeat count once (the larger). With fewer than
MIN_ROWS training rows in a class there is no model: every score is the
smoothed share of label 1 (0.5 without labels). An empty table gives no rows.
Extra columns are ignored. Repeated rows are scored each.
"""

from __future__ import annotations

import math

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import held_out, modest_batches, text_or_empty, training_labels, written

#: Fixed order of the statistics.
FEATURES = ["log_chars", "log_words", "log_word_len", "upper", "digit", "punct", "symbol", "bang", "pipe",
            "unique_words", "top_word", "short_words", "repeated_lines", "log_line_len", "repeated_triples",
            "log_sentence_len", "other_bytes", "space"]
MIN_ROWS = len(FEATURES) + 2
SHRINKAGE = 0.3
RIDGE = 0.05

_ASCII_PUNCT = [ord(c) for c in ".,;:'\"()-?"]
_ASCII_SYMBOL = [ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]


def statistics(text: str) -> np.ndarray:
    """The vector of one text; every entry is finite for every text."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    hist = np.bincount(data, minlength=256)
    size = len(data) + 1.0
    words = text.split()
    n = len(words) + 1.0
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    triples = len(words) - 2
    distinct = len(set(zip(words, words[1:], words[2:]))) if triples > 0 else 0
    sentences = hist[46] + hist[33] + hist[63] + 1.0

    def share(part: float, whole: float) -> float:
        return math.log(part / whole + 0.002)

    return np.array([
        math.log(size), math.log(n), math.log((size + 4) / n),
        share(upper, upper + lower + 1.0), share(hist[48:58].sum(), size), share(hist[_ASCII_PUNCT].sum(), size),
        share(hist[_ASCII_SYMBOL].sum(), size), share(hist[33], size), share(hist[124], size),
        math.log(len(counts) + 1.0) / math.log(n + 1.0), share(max(counts.values(), default=0), n),
        share(sum(k for w, k in counts.items() if len(w) <= 3), n),
        share(len(lines) - len(set(lines)), len(lines) + 1.0), math.log(size / (len(lines) + 1.0)),
        share(max(triples, 0) - distinct, n), math.log(n / sentences),
        share(hist[:32].sum() - hist[9] - hist[10] - hist[13] + hist[127], size),
        share(hist[32], size)])


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, x) with x the statistics of the whole text."""
    modest_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_md5": b["text_md5"], "x": [statistics(t) for t in b["text"]]})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                         F.md5(text_or_empty()).alias("text_md5"))
    return narrow.mapInPandas(run, "doc_id long, text_md5 string, x array<double>")


@dataclass
class Model:
    """Class means, inverse Cholesky factors and log determinants, or only the
    base rate where the labels can't carry a model."""
    base: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: list[np.ndarray] | None = None
    whiten: list[np.ndarray] | None = None
    constants: list[float] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.base)
        z = (x - self.center) / self.scale
        ld = [c - 0.5 * (((z - m) @ w.T) ** 2).sum(axis=1)
              for m, w, c in zip(self.means, self.whiten, self.constants)]
        return 1.0 / (1.0 + np.exp(-np.clip(ld[1] - ld[0], -60, 60)))


def sums_by_class(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per label: rows, sum of x, sum of x xT, over all rows of (y, x).
    Tasks hand over one partial sum per label; Spark adds them by position."""
    d = len(FEATURES)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
        for b in batches:
            x, y = np.stack(b["x"].to_numpy()) if len(b) else np.zeros((0, d)), b["y"].to_numpy()
            for k, v in held.items():
                part = x[y == k]
                v += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        yield pd.DataFrame({"y": list(held), "v": list(held.values())})

    parts = rows.select("y", "x").mapInPandas(partial, "y int, v array<double>")
    total = parts.select("y", F.posexplode("v").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v"))
    out = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
    for r in total.collect():  # 2 * (1 + d + d * d) rows
        out[r.y][r.i] = r.v
    return {y: (int(v[0]), v[1:1 + d], v[1 + d:].reshape(d, d)) for y, v in out.items()}


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Model:
    """The model of training rows (y, x)."""
    got = sums_by_class(rows)
    n = sum(g[0] for g in got.values())
    base = (got[1][0] + 1.0) / (n + 2.0)
    if min(g[0] for g in got.values()) < MIN_ROWS:
        return Model(base)
    center = sum(g[1] for g in got.values()) / n
    scale = np.sqrt(np.maximum(np.diag(sum(g[2] for g in got.values())) / n - center ** 2, 1e-6))

    def moments(g: tuple[int, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        m = g[1] / g[0]
        return (m - center) / scale, (g[2] / g[0] - np.outer(m, m)) / np.outer(scale, scale)

    stats = [moments(got[y]) for y in (0, 1)]
    pooled = sum(got[y][0] * stats[y][1] for y in (0, 1)) / n
    means, whiten, constants = [], [], []
    for y in (0, 1):
        cov = (1 - shrinkage) * stats[y][1] + shrinkage * pooled + ridge * np.eye(len(center))
        chol = np.linalg.cholesky((cov + cov.T) / 2)
        means.append(stats[y][0])
        whiten.append(np.linalg.inv(chol))
        constants.append(math.log(got[y][0] / n) - float(np.log(np.diag(chol)).sum()))
    return Model(base, center, scale, means, whiten, constants)


def score(docs: DataFrame, labels_df: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, text_md5 of every document."""
    x = written(with_statistics(docs), "quality-statistics")
    model = fit(x.join(training_labels(labels_df, "quality"), "doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["x"].to_numpy()) if len(b) else np.zeros((0, len(FEATURES)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_md5": b["text_md5"], "score": model.scores(v)})

    scored = x.mapInPandas(run, "doc_id long, text_md5 string, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "text_md5")
