"""Speed rows, daily batch views and their union for serving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.contracts import (
    DEVICE_SPEED, PHONE_SPEED, PLAYER_CSV_SPEED, PLAYER_RAW, PLAYER_SPEED, TICK_SPEED,
)
from tidewright.functions import dates as D
from tidewright.functions import numbers as N
from tidewright.operators.clean import typed_devices
from tidewright.operators.project import project_contract, union_aligned
from tidewright.operators.quality import complete_stats

STREAM, BATCH = "stream", "batch"
DEFAULT_DAYS = 30


# --- speed layer: one narrow pass per message, no shuffle -----------------------


def _tagged(df: DataFrame, millis: str = "crawl_timestamp", **more: Column) -> DataFrame:
    return df.withColumns({"@timestamp": D.from_millis(F.col(millis)), "view_type": F.lit(STREAM), **more})


def tick_speed(ticks: DataFrame) -> DataFrame:
    return project_contract(_tagged(ticks, price_date_dt=D.iso_date(F.col("price_date"))), TICK_SPEED)


def device_speed(devices: DataFrame) -> DataFrame:
    return project_contract(_tagged(typed_devices(devices)), DEVICE_SPEED)


def phone_speed(phones: DataFrame) -> DataFrame:
    return project_contract(_tagged(phones, crawl_date_dt=D.date_of_millis(F.col("crawl_timestamp"))), PHONE_SPEED)


def player_speed(players: DataFrame) -> DataFrame:
    named = players.withColumn("player_agent", F.coalesce("player_agent", F.lit("None")))
    return project_contract(complete_stats(_tagged(named)), PLAYER_SPEED)


def player_csv_speed(players: DataFrame) -> DataFrame:
    """Rows without an id cannot be keyed and are dropped."""
    keyed = players.filter(F.col("player_id").isNotNull())
    return project_contract(_tagged(keyed, "processing_timestamp"), PLAYER_CSV_SPEED)


# --- raw layer: partition columns -----------------------------------------------


def by_event_time(df: DataFrame, millis: str = "crawl_timestamp") -> DataFrame:
    """year, month, day from epoch milliseconds."""
    return df.withColumns(D.date_parts(D.from_millis(F.col(millis))))


def by_business_date(df: DataFrame, date: str = "price_date") -> DataFrame:
    """year, month, day from ISO text; text that is no date goes to the default partition."""
    return df.withColumns(D.date_parts(D.iso_date(F.col(date))))


def with_crawl_date(df: DataFrame, millis: str = "crawl_timestamp") -> DataFrame:
    return df.withColumn("crawl_date", D.date_of_millis(F.col(millis)))


def player_raw(players: DataFrame) -> DataFrame:
    return project_contract(complete_stats(by_event_time(players)), PLAYER_RAW)


# --- batch layer ------------------------------------------------------------------


def parse_days(argument: object = DEFAULT_DAYS) -> int | None:
    """Window argument: a number of days, or no window for ``all`` and for junk."""
    try:
        return int(argument)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return None


def trailing_days(df: DataFrame, days: int | None, as_of: dt.date | Column, date: str = "price_date",
                  partitioned: bool = False) -> DataFrame:
    """Rows dated no earlier than ``as_of - days``; there is no upper bound.

    ISO text compares like dates, so the filter stays on the stored column and
    is pushed to the scan. ``partitioned`` adds the same bound on year/month/day
    so that older folders are not even listed; rows in the default partition
    have no readable date, and text that sorts after the bound is kept as the
    filter on the text says.
    """
    if days is None:
        return df
    first = D.days_before(as_of, days)
    kept = df.filter(F.col(date) >= F.date_format(first, D.ISO))
    if partitioned:
        day = F.make_date("year", "month", "day")
        kept = kept.filter((day >= first) | F.col("year").isNull())
    return kept


def daily_view(ticks: DataFrame) -> DataFrame:
    """Averages, extremes and row count per day and type: one partial + final aggregate."""
    return (
        ticks.groupBy("price_date", "gold_type")
        .agg(
            F.avg("buy_price").alias("avg_buy_price"),
            F.avg("sell_price").alias("avg_sell_price"),
            F.min("buy_price").alias("min_buy_price"),
            F.max("buy_price").alias("max_buy_price"),
            F.min("sell_price").alias("min_sell_price"),
            F.max("sell_price").alias("max_sell_price"),
            F.count("*").alias("record_count"),
        )
        .withColumns({
            "view_type": F.lit(BATCH),
            "doc_id": F.concat("price_date", F.lit("_"), "gold_type"),
        })
    )


# --- serving ----------------------------------------------------------------------


def serving_union(batch_view: DataFrame, speed_view: DataFrame) -> DataFrame:
    """Both layers as one table, told apart by ``view_type``."""
    return union_aligned(batch_view, speed_view)


def serving_lookup(serving: DataFrame, view_type: str, first: dt.date, last: dt.date,
                   date: str = "price_date_dt") -> DataFrame:
    return serving.filter((F.col("view_type") == view_type)
                          & F.col(date).between(F.lit(first), F.lit(last)))


def repaired_height(players: DataFrame) -> DataFrame:
    return players.withColumn("player_height", N.height_metres(F.col("player_height")).cast("float"))
