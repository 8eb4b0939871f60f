"""Text to number, tolerant of dirty input: anything unreadable becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.text import first_word, last_word

# --- fixed values -------------------------------------------------------------
PLAIN_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"
THOUSANDS_NUMBER = r"^[0-9,]*[0-9][0-9,]*$"
MISSING = "N/A"
# ------------------------------------------------------------------------------


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def plain_number(text: Column) -> Column:
    """DOUBLE for ordinary decimal text; exponents, suffixes and words give NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double"))


def to_int_truncating(text: Column) -> Column:
    """INT from decimal text, cutting the fraction; NULL when unreadable or out of range."""
    return plain_number(text).try_cast("int")


def thousands(text: Column) -> Column:
    """``1,234,500`` to INT; anything but digits and commas gives NULL."""
    return F.when(text.rlike(THOUSANDS_NUMBER), F.replace(text, F.lit(","), F.lit("")).try_cast("int"))


def money_thousands(text: Column) -> Column:
    """Market value in thousands: ``€1.50m`` is 1500, ``€800k`` is 800, ``€5`` is 5."""
    amount = F.replace(first_word(text), F.lit("€"), F.lit(""))
    return (
        F.when(amount.contains("m"), plain_number(F.replace(amount, F.lit("m"), F.lit(""))) * 1000)
        .when(amount.contains("k"), plain_number(F.replace(amount, F.lit("k"), F.lit(""))))
        .otherwise(plain_number(amount))
    )


def abbreviated_count(text: Column) -> Column:
    """Sold count: ``1,2k`` is 1200 (decimal comma), ``42`` is 42."""
    count = F.lower(last_word(text))
    digits = F.trim(F.replace(F.replace(count, F.lit("k"), F.lit("")), F.lit(","), F.lit(".")))
    # Decimal, as 8.11 * 1000 is 8109.99... in binary.
    scaled = F.when(digits.rlike(PLAIN_NUMBER), digits.try_cast("decimal(18,6)")) * 1000
    return F.when(count.contains("k"), scaled.try_cast("int")).otherwise(to_int_truncating(count))


def digits_only(text: Column) -> Column:
    """Digits of a price text, ``N/A`` when there are none or the text is missing."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(digits != "", digits).otherwise(F.lit(MISSING))


def decimal_comma(text: Column) -> Column:
    """``1,85 m`` to 1.85."""
    return plain_number(F.replace(first_word(text), F.lit(","), F.lit(".")))


def stat_value(text: Column) -> Column:
    """Table cell to number: a dash counts as zero, a minute mark is cut."""
    cell = F.trim(F.split_part(text, F.lit("'"), F.lit(1)))
    return F.when(cell == "-", F.lit(0.0)).otherwise(plain_number(cell))


def discount_percent(new: Column, old: Column) -> Column:
    """Whole percent off, truncated toward zero; 0 when the old price is not positive."""
    return F.when(old > 0, ((old - new) / old * 100).try_cast("int")).when(old <= 0, F.lit(0))


def nan_to_null(number: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(~(F.isnan(number) | (F.abs(number) == float("inf"))), number)


def height_metres(height: Column) -> Column:
    """Heights above 10 are centimetres."""
    return F.when(height > 10, height / 100).otherwise(height)
