"""Rows generated per input row: days of a span, seasons of a league."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import dates as D


def date_spine(spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day from ``first`` to ``last`` inclusive, in both text forms, per input row."""
    day = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    return spans.select("*", day.alias("_day")).withColumns({
        "price_date": F.date_format("_day", D.ISO),
        "day_first": D.day_first(F.col("_day")),
    }).drop("_day")


def expand_seasons(leagues: DataFrame, base_url: Column, first: int, last: int) -> DataFrame:
    """One row and one address per league and season; the sequence lives in the row, so nothing is joined."""
    return leagues.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("season")).withColumn(
        "season_url", F.concat(base_url, F.col("season").cast("string")))
