"""Cleaning jobs: raw scraped text fields to typed columns, one pass per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.contracts import DEVICE, STAT_COLUMNS
from tidewright.functions import numbers as N
from tidewright.functions import text as X
from tidewright.sources.pages import NOT_RATED

PRODUCT_DEFAULTS = {"brand": N.MISSING, "color": N.MISSING, "category": N.MISSING, "name": N.MISSING}


def clean_products(raw: DataFrame) -> DataFrame:
    """Device tiles (text fields) to the device message: sizes, prices, discount, counts.

    An absent old price is the current price; absent words are ``N/A``; absent
    rating and sold count are 0. Sizes come from the name unless the tile has RAM and ROM fields.
    """
    named = X.storage_of_name(F.col("name"))
    storage = {c: F.col(c) if c in raw.columns else v for c, v in named.items()}
    price = F.col("price")
    price_old = F.coalesce("price_old", "price")
    percent = N.discount_percent(N.plain_number(price), N.plain_number(price_old))
    return raw.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(v)) for c, v in PRODUCT_DEFAULTS.items()},
        **{c: F.coalesce(v, F.lit(N.MISSING)) for c, v in storage.items()},
        "price": F.coalesce(price, F.lit(N.MISSING)),
        "price_old": F.coalesce(price_old, F.lit(N.MISSING)),
        "percent": percent.cast("string"),
        "rating": F.coalesce("rating", F.lit("0")),
        "sold": F.coalesce(N.abbreviated_count(F.col("sold")), F.lit(0)).cast("string"),
    }).select(*[c for c in DEVICE.columns if c in {*raw.columns, "RAM", "ROM", "percent"}])


def clean_phones(raw: DataFrame) -> DataFrame:
    """Phone tiles (text fields) to the phone message: name parts, digits of prices, counts."""
    parts = X.parts_of_name(F.col("name"))
    storage = X.storage_of_name(F.col("name"))
    full_name = F.size(X.words(F.col("name"))) >= 3
    paired = F.when(full_name & X.last_word(F.col("name")).contains("/"), F.lit(True))
    missing = F.lit(N.MISSING)
    return raw.withColumns({
        "name": F.coalesce("name", missing),
        **{c: F.coalesce(v, missing) for c, v in parts.items()},
        **{c: F.coalesce(F.when(paired, v), missing) for c, v in storage.items()},
        **{c: F.coalesce(F.col(c), missing) for c in ("screen_size", "resolution", "percent")},
        "new_price": N.digits_only(F.col("new_price")),
        "old_price": N.digits_only(F.col("old_price")),
        "rating": F.coalesce("rating", F.lit(NOT_RATED)),
        "sold": F.coalesce(N.abbreviated_count(F.col("sold")).cast("string"), missing),
    })


def clean_players(raw: DataFrame, stats: Sequence[str] = STAT_COLUMNS) -> DataFrame:
    """Profile and stat text to numbers: value in thousands, height in metres, dashes to 0."""
    present = [c for c in stats if c in raw.columns]
    return raw.withColumns({
        "age": N.plain_number(F.col("age")),
        "market_value": N.money_thousands(F.col("market_value")),
        "player_height": N.height_metres(N.decimal_comma(F.col("player_height"))),
        "player_agent": F.coalesce("player_agent", F.lit("None")),
        **{c: N.stat_value(F.col(c)) for c in present},
    })


def typed_devices(messages: DataFrame) -> DataFrame:
    """The device message's number-like text as FLOAT and INT; unreadable text is NULL."""
    return messages.withColumns({
        "price": N.to_float(F.col("price")),
        "price_old": N.to_float(F.col("price_old")),
        "percent": N.to_int_truncating(F.col("percent")),
        "rating": N.to_float(F.col("rating")),
        "sold": N.to_int_truncating(F.col("sold")),
    })


def null_out_nan(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL in every floating point column."""
    floating = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: N.nan_to_null(F.col(c)) for c in floating}) if floating else df
