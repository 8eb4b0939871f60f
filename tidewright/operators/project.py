"""Fitting rows to a contract, and comparing or aligning table schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.contracts import Contract


def project_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns in its order; anything else is dropped."""
    return df.select(*[F.col(f"`{c}`") for c in contract.columns])


def rename_and_drop(df: DataFrame, renames: Mapping[str, str] | None = None,
                    drop: Sequence[str] = ()) -> DataFrame:
    """Rename, then drop; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(renames or {})).drop(*drop)


def align_to(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None,
             fallback: object = None) -> DataFrame:
    """Exactly ``schema``: missing columns are added with a default, extra ones dropped."""
    given = defaults or {}
    present = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in present else F.lit(given.get(f.name, fallback)))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def union_aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is NULL for the other."""
    return left.unionByName(right, allowMissingColumns=True)


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column of either table: its type and count of values on each side.

    Each side is scanned once; an absent column has NULL type and count.
    """
    def described(df: DataFrame, side: str) -> DataFrame:
        counted = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
        rows = F.array(*[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias(f"{side}_type"),
                     F.col(f"`{f.name}`").alias(f"{side}_values"))
            for f in df.schema.fields
        ])
        return counted.select(F.inline(rows))

    joined = described(left, "left").join(described(right, "right"), "column", "full_outer")
    return joined.select(
        "column",
        F.col("left_type").isNotNull().alias("in_left"),
        F.col("right_type").isNotNull().alias("in_right"),
        "left_type", "right_type", "left_values", "right_values",
    )
