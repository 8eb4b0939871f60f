"""JSON messages to typed rows and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.contracts import Contract


def decode_json(envelope: DataFrame, contract: Contract,
                metadata: Mapping[str, str] | None = None) -> DataFrame:
    """Message bytes to the contract's columns.

    Extra keys vanish, missing keys and mistyped fields are NULL, a malformed
    message gives a row of NULLs. ``metadata`` maps envelope columns to the
    names under which they are kept.

    The struct is opened with ``inline`` rather than ``message.*``: a filter on a
    parsed field would otherwise be pushed below the projection and parse the
    text again for every condition in it.
    """
    kept = metadata or {}
    parsed = F.from_json(F.col("value").cast("string"), contract.schema)
    return envelope.select(
        *[F.col(source).alias(target) for source, target in kept.items()], F.inline(F.array(parsed))
    )


def encode_json(df: DataFrame, key: Column | None = None, timestamp: Column | None = None) -> DataFrame:
    """Every row as one flat JSON object; NULL fields are written, not dropped."""
    body = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    columns = [
        (F.lit(None).cast("string") if key is None else key.cast("string")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    ]
    if timestamp is not None:
        columns.append(timestamp.alias("timestamp"))
    return df.select(*columns)
