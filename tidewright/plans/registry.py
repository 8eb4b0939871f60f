"""Where queries are collected, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import apply_runtime_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: ISO text for dates, epoch microseconds for
    timestamps, DOUBLE for FLOAT."""
    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_micros(column).alias(field.name)
        if isinstance(field.dataType, T.FloatType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[cast(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is its DuckDB twin."""
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(apply_runtime_settings(spark), sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return build
    return register
