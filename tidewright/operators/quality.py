"""Row filters, validation with reasons, and one-pass table profiles."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.contracts import EXCLUDED_POSITION, STAT_COLUMNS, VALID_FEET


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(operator.and_, conditions)


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every named column, tested in one pass (NaN is a value)."""
    return df.filter(all_of([F.col(f"`{c}`").isNotNull() for c in columns]))


def complete_stats(df: DataFrame, columns: Sequence[str] = STAT_COLUMNS) -> DataFrame:
    return require_values(df, columns)


def outfield_strict(df: DataFrame) -> DataFrame:
    """No goalkeepers, known foot; a NULL in either column drops the row."""
    return df.filter((F.col("position") != EXCLUDED_POSITION) & F.col("strong_foot").isin(VALID_FEET))


def outfield_lenient(df: DataFrame) -> DataFrame:
    """As the strict rule, but a NULL is given the benefit of the doubt."""
    position, foot = F.col("position"), F.col("strong_foot")
    return df.filter((position.isNull() | (position != EXCLUDED_POSITION))
                     & (foot.isNull() | foot.isin(VALID_FEET)))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows without NULL and without NaN."""
    return df.na.drop("any")


# --- validation -----------------------------------------------------------------

# --- fixed values: fields a player record must carry, and those that are amounts
PLAYER_REQUIRED = (
    "player_id name player_club age position market_value nationality player_height strong_foot "
    "contract_value_time goalkeeper_or_not"
).split() + STAT_COLUMNS + ["crawl_timestamp"]
PLAYER_AMOUNTS = ["age", "market_value", "player_height", *STAT_COLUMNS, "crawl_timestamp"]
# ----------------------------------------------------------------------------------


def player_rules() -> dict[str, Column]:
    """Reason of rejection -> condition under which it applies."""
    rules = {f"missing_{c}": F.col(c).isNull() for c in PLAYER_REQUIRED}
    rules["goalkeeper"] = F.col("position") == EXCLUDED_POSITION
    rules["unknown_foot"] = ~F.col("strong_foot").isin(VALID_FEET)
    for c in PLAYER_AMOUNTS:
        # NaN sorts above every number, so it has to be named.
        rules[f"bad_{c}"] = F.isnan(F.col(c).cast("double")) | (F.col(c) < 0)
    return rules


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The input itself, or an error that names the required columns it lacks."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"input lacks required columns: {', '.join(absent)}")
    return df


def any_applies(rules: Mapping[str, Column]) -> Column:
    """Whether any rule does; an array, as the optimiser takes very long over a negated tree of many conditions."""
    return F.coalesce(F.array_contains(F.array(*rules.values()), True), F.lit(False))


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows to which no rule applies; plain conditions, so NULL tests reach the scan."""
    return df.filter(all_of([~F.coalesce(bad, F.lit(False)) for bad in rules.values()]))


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Every row kept, with the array of reasons for which it would be rejected.

    ``concat_ws`` skips NULLs and stays in generated code; filtering an array of
    optional reasons with a lambda does not.
    """
    text = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    none = F.array().cast("array<string>")
    return df.withColumn("reject_reasons", F.when(text == "", none).otherwise(F.split(text, ",")))


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return with_reasons(df, rules).filter(F.size("reject_reasons") > 0)


def reason_counts(checked: DataFrame) -> DataFrame:
    """How often each reason applied, with the accepted rows under ``accepted``."""
    return (
        checked.select(F.explode_outer("reject_reasons").alias("reason"))
        .select(F.coalesce("reason", F.lit("accepted")).alias("reason"))
        .groupBy("reason").agg(F.count("*").alias("row_count"))
    )


def count_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """As ``reason_counts`` over the rules themselves: one counter per reason in one aggregate, a row per task is shuffled."""
    counted = df.agg(F.count_if(~any_applies(rules)).alias("accepted"), *[F.count_if(bad).alias(name) for name, bad in rules.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("reason"), F.col(f"`{c}`").alias("row_count")) for c in counted.columns])
    # The array is filtered, not the rows: a filter above makes the optimiser infer constraints from every counter.
    return counted.select(F.inline(F.filter(rows, lambda r: r["row_count"] > 0)))


def observed(df: DataFrame, name: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Row counters taken while the rows flow by, on a table or a stream, without a job of their own.

    They arrive with the query's progress, or in a ``pyspark.sql.Observation`` of that name.
    """
    refused = any_applies(rules) if rules else F.lit(False)
    return df.observe(name, F.count(F.lit(1)).alias("row_count"), F.count_if(refused).alias("rejected_count"))


# --- profiles -------------------------------------------------------------------


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column, all columns in one scan."""
    names = list(columns or df.columns)
    counted = df.agg(F.count("*").alias("_rows"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"),
                              F.col(f"`{c}`").alias("null_count")) for c in names])
    return counted.select(F.inline(rows))


def profile_table(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Name, type, rows, NULLs and distinct values of every column, in one scan.

    Each row becomes one pair (column, digest of the value) per column; pairs are counted, and
    then the counts are summed per column. The first aggregate folds equal values before the
    shuffle and spreads the rest by hash, so neither a NULL nor any other frequent value gathers
    in a task, and texts are never shuffled. Digests are 128 bits of two hashes: two values meet
    in one with a chance of about n^2 / 2^129 for n distinct ones. Inexact: one aggregate of sketches.
    """
    fields = df.schema.fields
    if not exact_distinct:
        counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.struct(
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"), F.approx_count_distinct(f"`{f.name}`").alias("values")).alias(f.name) for f in fields])
        return counted.select(F.inline(F.array(*[F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.col("_rows").alias("row_count"),
            F.col(f"`{f.name}`.nulls").alias("null_count"), F.col(f"`{f.name}`.values").alias("distinct_count")) for f in fields])))

    def pair(place: int, field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        return F.struct(F.lit(place).alias("place"), value.isNull().alias("empty"),
                        F.xxhash64(F.lit(1), value).alias("low"), F.xxhash64(F.lit(2), value).alias("high"))

    pairs = df.select(F.inline(F.array(*[pair(i, f) for i, f in enumerate(fields)])))
    values = pairs.groupBy("place", "empty", "low", "high").agg(F.count("*").alias("rows"))
    counted = values.groupBy("place").agg(F.sum("rows").alias("row_count"), F.sum(F.when(F.col("empty"), F.col("rows")).otherwise(0)).alias("null_count"),
                                          F.count_if(~F.col("empty")).alias("distinct_count"))
    named = F.array(*[F.struct(F.lit(i).alias("of"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type")) for i, f in enumerate(fields)])
    names = df.sparkSession.range(1).select(F.inline(named))  # also for a table without rows
    zero = F.lit(0).cast("long")
    return names.join(counted, F.col("of") == F.col("place"), "left").select("column_name", "type", *[F.coalesce(c, zero).alias(c) for c in ("row_count", "null_count", "distinct_count")])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def nonempty(df: DataFrame) -> DataFrame:
    """The input itself, or an error when it has no rows; stops at the first row found."""
    if df.isEmpty():
        raise ValueError("input has no rows")
    return df
