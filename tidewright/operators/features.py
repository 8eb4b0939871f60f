"""Feature preparation in native expressions: splits, indexes, one-hot, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.contracts import LOG_COLUMNS
from tidewright.functions import dates as D
from tidewright.session import cut_lineage

# --- fixed values: multiplicative hash --------------------------------------------
HASH_FOLD = 2147483647          # 2^31 - 1, keeps the product inside BIGINT
HASH_MULTIPLIER = 2654435761    # 2^32 / golden ratio
HASH_MODULUS = 4294967296       # 2^32
HASH_LOW_BITS = 16              # bits dropped from the low end
# ------------------------------------------------------------------------------------

TRAIN_TEST = {"train": 80, "test": 20}
TRAIN_VALIDATION_TEST = {"train": 70, "validation": 10, "test": 20}


def text_number(text: Column) -> Column:
    """A stable 32-bit number for a text: the first eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def hash_percent(key: Column) -> Column:
    """A stable number 0..99 for an integer key, the same on any partitioning.

    Row-local, so splitting needs no shuffle and no hot stratum can form; a row
    that is recomputed after a lost executor lands in the same split.
    """
    mixed = F.pmod(key.cast("long"), F.lit(HASH_FOLD).cast("long")) * F.lit(HASH_MULTIPLIER)
    high = F.shiftright(F.pmod(mixed, F.lit(HASH_MODULUS)), HASH_LOW_BITS)
    return F.pmod(high, F.lit(100)).cast("int")


def with_split(df: DataFrame, key: Column, shares: Mapping[str, int] = TRAIN_TEST,
               name: str = "split") -> DataFrame:
    """Adds the split each row belongs to; shares are percentages that sum to 100."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must sum to 100")
    bucket, upper, chosen = hash_percent(key), 0, None
    for split, share in shares.items():
        upper += share
        test = bucket < upper
        chosen = F.when(test, F.lit(split)) if chosen is None else chosen.when(test, F.lit(split))
    return df.withColumn(name, chosen)


def with_stratified_split(df: DataFrame, stratum: Column, key: Column,
                          shares: Mapping[str, int] = TRAIN_VALIDATION_TEST, name: str = "split") -> DataFrame:
    """The shares hold inside each stratum, drawn independently per stratum, in one narrow pass.

    The stratum shifts the key, so the strata do not all pick the same keys.
    """
    shifted = F.pmod(key.cast("long"), F.lit(HASH_FOLD).cast("long")) + text_number(stratum)
    return with_split(df, shifted, shares, name)


def split_distribution(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


# --- label index ---------------------------------------------------------------------


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """Labels numbered from 0 by falling frequency, ties by label: (label, count, index).

    The ordering is a range-partitioned sort. Each partition numbers its own
    rows and adds the sizes of the partitions before it, so no task ever holds
    all labels. The checkpoint pins the partitioning between the two steps.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("label_count"))
    ordered = (
        counts.repartitionByRange(F.desc("label_count"), F.asc(column))
        .withColumn("_part", F.spark_partition_id())
    )
    pinned = cut_lineage(ordered)
    # One row per range partition, so this window is over a handful of rows.
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_size")).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("label_count"), F.asc(column)))
    return pinned.join(F.broadcast(before), "_part").select(
        F.col(column).alias("label"), "label_count",
        (F.col("_before") + place - 1).cast("double").alias("label_index"),
    )


def apply_index(df: DataFrame, labels: DataFrame, column: str, output: str, invalid: str = "keep") -> DataFrame:
    """Label numbers joined on; an unseen or NULL label gets the number of labels (``keep``),
    drops its row (``skip``) or fails the job (``error``)."""
    fitted = labels.select(F.col("label").alias(column), F.col("label_index").alias(output))
    n_labels = labels.count()
    joined = df.join(fitted, column, "inner" if invalid == "skip" else "left")
    if invalid == "keep":
        joined = joined.withColumn(output, F.coalesce(output, F.lit(float(n_labels))))
    elif invalid == "error":
        joined = joined.withColumn(
            output, F.coalesce(output, F.raise_error(F.lit(f"unseen label in {column}")).cast("double")))
    return joined.select(*df.columns, output)


def one_hot(df: DataFrame, index: str, size: int, prefix: str) -> DataFrame:
    """``size - 1`` indicator columns; the last index is all zeros.

    After ``apply_index`` with ``keep``, ``size`` is the number of labels + 1: each label
    has its own column and only the unseen or NULL label is all zeros.
    """
    return df.withColumns({
        f"{prefix}_{i}": F.when(F.col(index) == i, F.lit(1.0)).otherwise(F.lit(0.0)) for i in range(size - 1)
    })


# --- numeric features -----------------------------------------------------------------


def log_features(df: DataFrame, columns: Sequence[str] = LOG_COLUMNS) -> DataFrame:
    """``x_log = ln(1 + x)`` for each column, all in one projection."""
    return df.withColumns({f"{c}_log": F.log1p(F.col(c).cast("double")) for c in columns})


def log_names(columns: Sequence[str], logged: Sequence[str] = LOG_COLUMNS) -> list[str]:
    return [f"{c}_log" if c in logged else c for c in columns]


def calendar_features(df: DataFrame, date: str = "price_date") -> DataFrame:
    """year, month and day of an ISO date text as DOUBLE."""
    return df.withColumns({k: v.cast("double") for k, v in D.date_parts(D.iso_date(F.col(date))).items()})


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled",
                   fitted_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample deviation per column; a constant column becomes 0.

    The statistics are one row of scalars from one aggregate over ``fitted_on``
    (default: the input), read by the projection as a scalar subquery.
    """
    source = df if fitted_on is None else fitted_on
    fit = source.agg(F.struct(*[
        value.alias(f"{c}_{kind}") for c in columns
        for kind, value in (("mean", F.avg(F.col(c).cast("double"))), ("dev", F.stddev_samp(F.col(c).cast("double"))))
    ]).alias("fit")).scalar()
    with_fit = df.withColumn("_fit", fit)
    return with_fit.withColumns({
        f"{c}{suffix}": F.when(F.col(f"_fit.{c}_dev") == 0, F.lit(0.0)).otherwise(
            (F.col(c).cast("double") - F.col(f"_fit.{c}_mean")) / F.col(f"_fit.{c}_dev"))
        for c in columns
    }).drop("_fit")


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "skip") -> DataFrame:
    """Dense vector of the columns; ``skip`` drops rows with NULL or NaN in any of them."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The vector's slots as plain columns."""
    slots = vector_to_array(F.col(vector))
    return df.withColumns({name: slots[i] for i, name in enumerate(names)}).drop(vector)
