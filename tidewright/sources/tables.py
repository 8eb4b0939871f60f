"""Parquet and CSV tables: scans, partition pruning, writes and compaction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import BOM

DATE_PARTITIONS = ("year", "month", "day")


def scan(spark: SparkSession, path: str, merge_schema: bool = False,
         schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with partition discovery.

    ``merge_schema`` reads every footer, so use it only where files really
    differ; passing ``schema`` gives the same columns without touching footers.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(path)


def days_between(lo: dt.date | None, hi: dt.date | None = None,
                 parts: Sequence[str] = DATE_PARTITIONS) -> Column:
    """Predicate over year/month/day partition columns, so whole folders are pruned.

    A filter on a date *string* column only reaches row groups; this one reaches
    the directory listing.
    """
    day = F.make_date(*[F.col(p) for p in parts])
    bounds = [F.lit(True)]
    if lo is not None:
        bounds.append(day >= F.lit(lo))
    if hi is not None:
        bounds.append(day <= F.lit(hi))
    condition = bounds[0]
    for bound in bounds[1:]:
        condition = condition & bound
    return condition


def write_partitioned(df: DataFrame, path: str, parts: Sequence[str] = DATE_PARTITIONS,
                      mode: str = "append") -> None:
    """Partitioned Parquet with well-sized files.

    The rebalance hint lets adaptive execution split a partition value that
    holds most of the rows and merge the small ones.
    """
    df.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table at ``path``, bucketed and sorted by its key, so that joins and aggregates by that key don't shuffle it."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)


def compact(spark: SparkSession, source: str, target: str, parts: Sequence[str] = DATE_PARTITIONS) -> None:
    """Rewrite many small landed files into few large ones, in a new folder."""
    write_partitioned(scan(spark, source), target, parts, mode="errorifexists")


def on_days(days: Sequence[dt.date], parts: Sequence[str] = DATE_PARTITIONS) -> Column:
    """Predicate over year/month/day partition columns for a list of days; prunes folders."""
    return F.make_date(*[F.col(p) for p in parts]).isin(*[F.lit(d) for d in days])


def compact_days(spark: SparkSession, source: str, target: str, days: Sequence[dt.date],
                 parts: Sequence[str] = DATE_PARTITIONS) -> None:
    """Rewrite the landed files of some days into few files of ``target``; folders of other days stay as they are.

    Only the folders of these days are read, and of ``target`` only those that the rows fall into are replaced, so a
    repeated run changes nothing and a day may be compacted again after late files arrived.
    """
    chosen = scan(spark, source).filter(on_days(days, parts)).hint("rebalance", *parts)
    chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with header against a declared schema (no inference pass).

    A header that names other columns, or the same in another order, is an error
    rather than values in the wrong column. ``multi_line`` accepts line breaks
    inside quotes but makes files unsplittable.
    """
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        .csv(path)
    )


def clean_header(df: DataFrame) -> DataFrame:
    """Drop a byte order mark and blanks around column names."""
    return df.withColumnsRenamed({c: c.lstrip(BOM).strip() for c in df.columns})


def export_csv(df: DataFrame, path: str, columns: Sequence[str]) -> bool:
    """Chosen columns to a CSV folder; nothing is written for an empty input."""
    chosen = df.select(*columns)
    if chosen.isEmpty():
        return False
    chosen.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return True
