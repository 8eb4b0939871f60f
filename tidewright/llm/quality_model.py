"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each class is a normal density over transformed statistics of whole texts. Its mean and
covariance come from sums over all labelled training rows (one aggregate); the covariance
is shrunk towards that of both classes and towards its own diagonal. The Cholesky factor
of each class is computed once and sent with the scoring function. The score is the
logistic of the difference of log densities and priors.

Nulls: a null text counts as empty; rows without label don't train; with no label at all
each score is 0.5; with labels of one class only, the other class takes the common mean
with a wider covariance. Repeated rows score alike; repeated labels of a document count
each. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import bucket_of, kept_table
from tidewright.llm.text_stats import text_stats

FOLDS, TEST_FOLD = 5, 0
THRESHOLD = 0.3
DIMS = 10


def features(stats: DataFrame) -> DataFrame:
    """COUNTS to the array ``x``: logs and square roots of shares, nearer to normal than the shares."""
    words = F.greatest("n_words", F.lit(1)).cast("double")
    root = lambda part: F.sqrt(F.col(part) / words)
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1)).cast("double")
    return stats.withColumn("x", F.array(
        F.log1p("n_words"), F.log1p(F.col("word_chars") / words), F.log1p(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")), root("n_repeat_words"),
        F.sqrt(F.col("n_upper") / letters), root("n_stops"), F.log1p(F.col("n_marks") / words), root("n_short_words"),
        F.col("n_distinct_words") / words))


class Discriminant:
    """Mean, Cholesky factor, log determinant and log prior of each class."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float, ridge: float):
        self.trained = bool(counts.sum() > 0)
        if not self.trained:
            return
        total = counts.sum()
        common_mean = sums.sum(axis=0) / total
        common = squares.sum(axis=0) / total - np.outer(common_mean, common_mean)
        d = len(common_mean)
        self.means, self.factors, self.logs = [], [], []
        for k in (0, 1):
            n = counts[k]
            mean = (sums[k] + shrink * common_mean) / (n + shrink)
            own = squares[k] / n - np.outer(sums[k] / n, sums[k] / n) if n else common
            weight = n / (n + shrink * d)
            cov = weight * own + (1 - weight) * common
            cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + ridge * np.eye(d)
            factor = np.linalg.cholesky(cov)
            self.means.append(mean)
            self.factors.append(factor)
            self.logs.append(np.log((n + 1) / (total + 2)) - np.log(np.diag(factor)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), 0.5)
        logs = [log - 0.5 * (np.linalg.solve(factor, (x - mean).T) ** 2).sum(axis=0) for mean, factor, log in zip(self.means, self.factors, self.logs, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit_discriminant(labelled: DataFrame, shrink: float = 5.0, ridge: float = 1e-3) -> Discriminant:
    """From rows of (x, label 0 or 1). The driver gets the sums of two classes, whatever the rows."""
    moments = [F.count("*").alias("n")] + [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(DIMS)]
    moments += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}_{j}") for i in range(DIMS) for j in range(i, DIMS)]
    counts, sums, squares = np.zeros(2), np.zeros((2, DIMS)), np.zeros((2, DIMS, DIMS))
    for row in labelled.where(F.col("label").isin(0, 1)).groupBy("label").agg(*moments).collect():
        k = int(row["label"])
        counts[k], sums[k] = row["n"], [row[f"s{i}"] for i in range(DIMS)]
        for i in range(DIMS):
            for j in range(i, DIMS):
                squares[k, i, j] = squares[k, j, i] = row[f"q{i}_{j}"]
    return Discriminant(counts, sums, squares, shrink, ridge)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = features(kept_table(text_stats(docs, ["doc_id"]), "classifier-stats")).withColumn("held_out", bucket_of("doc_id", FOLDS) == TEST_FOLD)
    marks = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("label"))
    training = stats.where(~F.col("held_out")).join(marks, F.col("doc_id") == F.col("__id")).select("x", "label")
    model = fit_discriminant(training)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(np.round(model.score(np.stack(x.to_numpy())), 9)) if len(x) else pd.Series([], dtype="float64")

    scored = stats.withColumn("score", score("x"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
