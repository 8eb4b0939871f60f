"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

Each document is a vector of transformed statistics. Per language and source, location
and scatter are those of the half of the documents whose scatter has the least
determinant (concentration steps from a median start). A document is rejected if its
squared Mahalanobis distance to the estimate of its language and source passes a
chi-square quantile.

A group of any size is dealt by hash into blocks of about ``block_rows`` documents; each
block gives an estimate and the group takes their mean weighted by rows, so no task sees
a whole group and all documents take part. Groups lean on their language, and languages
on the whole corpus, with the weight of ``prior_rows`` documents. A floor under each
statistic's deviation (FLOORS) keeps statistics that are nearly constant among most
documents from rejecting those that merely are not zero.

Nulls: a null text has no words; a null language or source is a group of its own; rows
with a null ``doc_id`` are judged like all others. Repeated rows are judged alike. An
empty table gives no rows.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import ROW_KEY, kept_table, rows_named, with_row_key
from tidewright.llm.text_stats import text_stats

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Least deviation that counts, by transformed statistic.
FLOORS = {"log_word_length": 0.06, "symbols": 0.10, "dup_lines": 0.12, "repeats": 0.10, "upper": 0.04, "short": 0.05, "marks": 0.10}
DIMS = len(FLOORS)
TAIL = 1e-4


def chi_square(p: float, d: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's approximation)."""
    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(p) * (2 / (9 * d)) ** 0.5) ** 3


def transformed(stats: DataFrame) -> DataFrame:
    """COUNTS to the array ``x`` of transformed statistics, in the order of FLOORS."""
    words = F.greatest("n_words", F.lit(1)).cast("double")
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1)).cast("double")
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1)).cast("double")
    return stats.withColumn("x", F.array(
        F.log((F.col("word_chars") + 1) / words), F.log1p(share("n_symbols", "n_words")), share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"), F.col("n_upper") / letters, share("n_short_words", "n_words"),
        F.log1p(share("n_marks", "n_words"))))


def mcd(x: np.ndarray, floors: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Location and scatter of the rows of ``x`` by concentration steps on half of them."""
    n, d = x.shape
    centre = np.median(x, axis=0)
    scatter = np.diag(np.maximum(1.4826 * np.median(np.abs(x - centre), axis=0), floors) ** 2)
    half = max(1, (n + d + 1) // 2)
    if n > 2 * d:
        taken = None
        for _ in range(steps):
            distance = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            order = np.sort(np.argsort(distance, kind="stable")[:half])
            if taken is not None and np.array_equal(order, taken):
                break
            taken, rows = order, x[order]
            centre = rows.mean(axis=0)
            scatter = np.cov(rows, rowvar=False, bias=True) + np.diag((0.1 * floors) ** 2)
        distance = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
        scatter = scatter * max(1.0, np.median(distance) / chi_square(0.5, d))
    return centre, scatter + np.diag(floors ** 2)


def outlier_model(vectors: DataFrame, block_rows: int = 2000, prior_rows: int = 100) -> DataFrame:
    """(lang, source, mean, scatter) from rows of (doc_id, lang, source, x); scatter is flat."""
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("group_rows")).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    dealt = vectors.join(sizes, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))).select(
        "lang", "source", "x", F.pmod(F.xxhash64("doc_id", "x"), F.ceil(F.col("group_rows") / block_rows)).alias("block"))
    floors = np.array(list(FLOORS.values()))

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["x"].to_numpy())
        centre, scatter = mcd(x[np.lexsort(x.T)], floors)
        return pd.DataFrame({"lang": [key[0]], "source": [key[1]], "n": [float(len(x))], "parts": [np.concatenate([centre, scatter.ravel()])]})

    blocks = dealt.groupBy("lang", "source", "block").applyInPandas(fit, "lang string, source string, n double, parts array<double>")
    cells = F.array(*[F.sum(F.col("n") * F.col("parts")[k]) for k in range(DIMS + DIMS * DIMS)])
    groups = kept_table(blocks.groupBy("lang", "source").agg(F.sum("n").alias("n"), cells.alias("sums")), "mcd")
    again = F.array(*[F.sum(F.col("sums")[k]) for k in range(DIMS + DIMS * DIMS)])
    langs = groups.groupBy("lang").agg(F.sum("n").alias("l_n"), again.alias("l_sums")).withColumnRenamed("lang", "l_lang")
    whole = groups.agg(F.sum("n").alias("a_n"), again.alias("a_sums"))  # one row
    lean = lambda sums, n, mean: F.zip_with(sums, mean, lambda s, m: (s + prior_rows * m) / (n + prior_rows))
    langs = langs.join(F.broadcast(whole)).select("l_lang", lean("l_sums", F.col("l_n"), F.transform("a_sums", lambda s: s / F.col("a_n"))).alias("l_mean"))
    fitted = groups.join(langs, F.col("lang").eqNullSafe(F.col("l_lang"))).select("lang", "source", lean("sums", F.col("n"), F.col("l_mean")).alias("parts"))
    return fitted.select(F.col("lang").alias("m_lang"), F.col("source").alias("m_source"), "parts")


def score_outliers(stats: DataFrame, model: DataFrame) -> DataFrame:
    """``stats`` with ``distance``, the squared Mahalanobis distance to its group's estimate."""
    joined = stats.join(model, F.col("lang").eqNullSafe(F.col("m_lang")) & F.col("source").eqNullSafe(F.col("m_source")), "left")

    @F.pandas_udf("double")
    def distance(x: pd.Series, parts: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        known = parts.notna().to_numpy()  # a group without a single good document has no estimate
        if known.any():
            points, models = np.stack(x[known].to_numpy()), np.stack(parts[known].to_numpy())
            z = points - models[:, :DIMS]
            scatter = models[:, DIMS:].reshape(-1, DIMS, DIMS)
            out[known] = np.einsum("ij,ij->i", z, np.linalg.solve(scatter, z[:, :, None])[:, :, 0])
        return pd.Series(out)

    return joined.withColumn("distance", F.nanvl(F.round(distance("x", "parts"), 6), F.lit(None).cast("double"))).drop("m_lang", "m_source", "parts")


def row_verdicts(docs: DataFrame, block_rows: int = 2000, tail: float = TAIL) -> DataFrame:
    """The columns of ``quality_rules`` and ROW_KEY, a row per row of ``docs``."""
    stats = kept_table(text_stats(with_row_key(docs.select("doc_id", "text", "lang", "source")), ["doc_id", "lang", "source", *ROW_KEY]), "quality-stats").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    vectors = transformed(stats)
    model = outlier_model(vectors.where(~F.col("base_failed")).select("doc_id", "lang", "source", "x"), block_rows)
    scored = score_outliers(vectors, model)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_square(1 - tail, DIMS), F.lit(False))).alias("kept"), "distance", *ROW_KEY)


def quality_rules(docs: DataFrame, block_rows: int = 2000, tail: float = TAIL) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    The base rules fail a text with fewer than 50 words or with over half of its words in
    repeated three-word windows. They don't take part in the estimates.
    """
    return row_verdicts(docs, block_rows, tail).drop(*ROW_KEY)


def drop_rejected(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``verdicts`` (of ``row_verdicts``) doesn't keep; columns as they came.

    A row is named by id and text; rows of one id and text under two sources go if one of them is rejected.
    """
    return rows_named(docs, verdicts.where(~F.coalesce("kept", F.lit(False))), "left_anti")
