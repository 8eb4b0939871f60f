"""Names, words and addresses taken apart with Spark string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
STORAGE_SIZE = r"^[0-9]+(GB|TB)$"
STORAGE_PAIR = r"^([0-9]+(?:GB|TB))/([0-9]+(?:GB|TB))$"
URL_TAIL_ID = r"/([0-9]+)([?#]|$)"
BOM = "\ufeff"
# ------------------------------------------------------------------------------


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def words(text: Column) -> Column:
    """Whitespace separated words; an empty array for blank text."""
    trimmed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def first_word(text: Column) -> Column:
    return F.split_part(F.trim(text), F.lit(" "), F.lit(1))


def last_word(text: Column) -> Column:
    return F.try_element_at(words(text), F.lit(-1))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """First regex group, NULL instead of empty text when nothing matched."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


def nth_match(text: Column, pattern: str, position: int | Column, group: int = 1) -> Column:
    """The ``position``-th (1-based) match, NULL when there are fewer."""
    index = F.lit(position) if isinstance(position, int) else position
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), index)


def storage_of_name(name: Column) -> dict[str, Column]:
    """RAM and ROM from the last word of a device name.

    Only sizes count: ``12GB/256GB`` gives both, ``256GB`` gives ROM, other words give neither.
    """
    tail = last_word(name)
    several = F.size(words(name)) >= 2
    return {
        "RAM": F.when(several, first_match(tail, STORAGE_PAIR, 1)),
        "ROM": F.when(several, F.coalesce(first_match(tail, STORAGE_PAIR, 2), first_match(tail, STORAGE_SIZE, 0))),
    }


def parts_of_name(name: Column) -> dict[str, Column]:
    """Brand, model and capacity from first, middle and last words of a phone name."""
    tokens = words(name)
    count = F.size(tokens)
    return {
        "brand": F.try_element_at(tokens, F.lit(1)),
        "model": F.when(count >= 3, F.array_join(F.slice(tokens, F.lit(2), F.greatest(count - 2, F.lit(0))), " ")),
        "capacity": F.when(count >= 2, F.try_element_at(tokens, F.lit(-1))),
    }


def url_id(url: Column) -> Column:
    """Digits closing the path of an address."""
    return first_match(url, URL_TAIL_ID, 1)


def url_slug(url: Column, stop: str = "/profil") -> Column:
    """Path between the host and ``stop``, blanks turned to hyphens."""
    path = F.regexp_replace(url, r"^[a-z]+://[^/]+/", "")
    return F.replace(F.split_part(path, F.lit(stop), F.lit(1)), F.lit(" "), F.lit("-"))


def join_url(base: str, *parts: Column | str) -> Column:
    """Address built by concatenation."""
    return F.concat(F.lit(base), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def strip_bom(text: Column) -> Column:
    return F.ltrim(text, F.lit(BOM))
