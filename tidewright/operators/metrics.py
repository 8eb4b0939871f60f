"""Regression quality as plain aggregates, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MSE and R² in one pass; R² is NULL when the labels do not vary."""
    actual, guess = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = scored.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.avg((guess - actual) * (guess - actual)).alias("mse"),
        F.var_pop(actual).alias("_spread"),
    )
    return sums.select(
        *by, "row_count", F.sqrt("mse").alias("rmse"), "mse",
        (1 - F.try_divide("mse", F.nullif("_spread", F.lit(0.0)))).alias("r2"),
    )
