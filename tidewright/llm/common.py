"""What several operators here share: reading, keeping intermediate tables, Arrow output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import scratch_path

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark drops the shuffles of a finished query at once, and not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the folder all executors share, and read from there.

    The shuffles that led to them are dropped as soon as they are written, so that the disk
    never holds those of several steps.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def batch_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type, from_pandas=False) for f in schema], schema=schema)


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out
    return run


def bucket_of(column: str, n: int):
    """Remainder 0 <= b < n of crc32 of the column as text (null: 0)."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0)) % n


ROW_KEY = ("__text_a", "__text_b")


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with 128 bits of its text: with ``doc_id`` they name a row, also among null or repeated ids."""
    return docs.withColumns({name: F.xxhash64(F.lit(salt), F.col("text")) for salt, name in enumerate(ROW_KEY)})


def rows_named(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that ``named`` lists, ``left_semi``, or doesn't, ``left_anti``; columns as they came.

    ``named`` has doc_id and ROW_KEY; without ROW_KEY, rows are named by their id alone.
    """
    keys = [c for c in ROW_KEY if c in named.columns]
    listed = named.select(F.col("doc_id").alias("__id"), *[F.col(c).alias(f"{c}_of") for c in keys]).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    for c in keys:
        same = same & (F.col(c) == F.col(f"{c}_of"))
    return (with_row_key(docs) if keys else docs).join(listed, same, how).select(*[F.col(f"`{c}`") for c in docs.columns])
