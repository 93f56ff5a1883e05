"""Quality classifier: regularised quadratic discriminant over document statistics.

Each document becomes a short vector of statistics, transformed towards a bell shape.
Per label the mean and covariance come from sums over all labelled rows, added up on
Spark; the covariance is shrunk towards the pooled one and towards its diagonal. A score
is the logistic of the difference of the two Gaussian log-densities (Mahalanobis
distances through Cholesky factors that are computed once) plus the log of the priors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.llm.common import free_names, whole_text

UPPER, LOWER, DIGIT = 0, 1, 2
MARKS = b"!|*#$%&@^~_=+<>\\{}[]"

FEATURES = [
    "words", "word length", "distinct words", "repeated neighbours", "most frequent word", "capitals", "capital words",
    "exclamation marks", "bars", "other symbols", "digits", "full stops and commas", "lines", "repeated lines", "worst line", "word forms",
]


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text; an empty one has defined values, too."""
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    n = max(len(data), 1)
    words = text.split()
    w = max(len(words), 1)
    capitals, smalls = int(count[65:91].sum()), int(count[97:123].sum())
    letters = max(capitals + smalls, 1)
    distinct = len(set(words))
    neighbours = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    symbols = int(sum(count[b] for b in MARKS if b not in b"!|"))
    top = max(Counter(words).values(), default=0)
    shouted = sum(map(str.isupper, words))
    odd = 0.0
    for line in lines:
        own = line.split()
        if own:
            marks = sum(line.count(c) for c in "!|*#$%&")
            loud = sum(map(str.isupper, own))
            odd = max(odd, (marks + loud + sum(map(eq, own, own[1:]))) * (len(own) > 3) / len(own))
    root = np.sqrt
    return [
        np.log1p(len(words)), np.log1p(len(data) / w), np.log((distinct + 1) / (w + 1)), root(neighbours / w), root(top / w),
        root(capitals / letters), root(shouted / w), root(int(count[33]) / w), root(int(count[124]) / w), root(symbols / w),
        root(int(count[48:58].sum()) / n), root(int(count[46] + count[44]) / w), np.log1p(len(lines)),
        root(1 - len(set(lines)) / max(len(lines), 1)), root(min(odd, 4.0)), root(sum(map(str.isalpha, words)) / w),
    ]


def features(text: Column) -> Column:
    """Array of the statistics of a text; null counts as empty."""

    @F.pandas_udf("array<double>")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[float(x) for x in statistics(t or "")] for t in texts], dtype=object)

    return udf(text)


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors, log-determinants and log priors; class 1 is good."""

    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray
    prior: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        density = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            density.append(self.prior[k] - 0.5 * (np.einsum("ij,ij->i", z, z) + self.log_det[k]))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def from_moments(n: np.ndarray, total: np.ndarray, product: np.ndarray, pool: float, ridge: float) -> Discriminant:
    """Discriminant from counts, sums and sums of products of the two classes (any may be empty)."""
    d = total.shape[1]
    count = np.maximum(n, 1)[:, None]
    mean = total / count
    own = product / count[:, :, None] - mean[:, :, None] * mean[:, None, :]
    shared = (n[:, None, None] * own).sum(axis=0) / max(n.sum(), 1)
    factor, log_det = [], []
    for k in (0, 1):
        cov = (1 - pool) * own[k] + pool * shared if n[k] > d else shared
        cov = (1 - ridge) * cov + ridge * np.diag(np.diag(cov)) + 1e-4 * np.eye(d)
        low = np.linalg.cholesky(cov)
        factor.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    prior = np.log((n + 1) / (n.sum() + 2))
    if not n.all():  # one class only: nothing tells documents apart, so the prior decides
        mean = np.repeat(mean[[int(n.argmax())]], 2, axis=0)
        factor, log_det = [factor[0]] * 2, [log_det[0]] * 2
    return Discriminant(mean, np.array(factor), np.array(log_det), prior)


def fit(labelled: DataFrame, pool: float = 0.1, ridge: float = 0.01) -> Discriminant:
    """Fit on all rows (features array<double>, label 0/1); other labels and null are left out.

    Only sums leave the executors: one row per class.
    """
    d = len(FEATURES)
    x = [F.col("features")[i] for i in range(d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    rows = labelled.where("label in (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s")).collect()
    n, total, product = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    upper = np.triu_indices(d)
    for r in rows:
        k = int(r.label)
        n[k], total[k] = r.n, r.s[:d]
        product[k][upper] = r.s[d:]
        product[k] = product[k] + np.triu(product[k], 1).T
    return from_moments(n, total, product, pool, ridge)


def score(column: Column, model: Discriminant) -> Column:
    """Score between 0 and 1 of a features column."""

    @F.pandas_udf("double")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in parts:
            yield pd.Series(model.score(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")

    return udf(column)


def text_score(text: Column, model: Discriminant) -> Column:
    """Score of a text in one step."""

    @F.pandas_udf("double")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.score(np.array([statistics(t or "") for t in texts])) if len(texts) else [], dtype="float64")

    return udf(text)


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(label, features) of the documents that have a label; only ids and labels meet the documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label is not null")
    vectors = docs.select(F.col(id_col).alias("id"), features(whole_text(text_col)).alias("features"))
    return vectors.join(known, "id").select("label", "features")


def drop_low_quality(docs: DataFrame, model: Discriminant, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """`docs` without the rows that score below `least`; columns stay as they are."""
    (name,) = free_names(docs, "score")
    return docs.withColumn(name, text_score(whole_text(text_col), model)).where(F.col(name) >= least).drop(name)
