"""Latest row per key, keyed replace and keyed merge.

Replace and merge come in three plans with the same result; the caller says what is known of
the sizes. FEW updates: the base stays where it is and the updates are joined to it. MANY (of
the base's own order of size): base and updates are one union and one aggregate per key picks
the values, so each input is read once and one shuffle serves both. BUCKETED (a base stored by
``tables.write_bucketed`` with the same key): a full join, for which only the updates move.

Rows of a key are folded by a grouped aggregate with ``max_by``. Spark folds the rows of a
key on the map side first, so a key that holds a third of all rows still sends
one row per task over the network; a ranking window would sort them all in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALONE, IS_NEW = "_alone", "_is_new"
FEW, MANY, BUCKETED = "few", "many", "bucketed"


def _order(order: Sequence[str]) -> Column:
    # A struct is never NULL itself, so rows with a NULL time lose instead of vanishing.
    return F.struct(*[F.col(f"`{c}`") for c in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, whole; ties are settled by the later columns of ``order``."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), _order(order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*[F.col(f"`{c}`") for c in df.columns])


def replace_by_key(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str],
                   plan: str = FEW) -> DataFrame:
    """Base with rows replaced by newer updates; an older update does not win, an equally old one does."""
    if plan == MANY:
        rows = _together(base, updates, keys)
        newest = latest_per_key(rows, [*keys, ALONE], [*order, IS_NEW])
        return newest.drop(ALONE, IS_NEW).select(*_columns(base, updates))

    def newer(column: str) -> Column:
        old, new = _order(order), F.struct(*[F.col(f"_new.`{c}`") for c in order])
        wins = F.col("_new").isNotNull() & (new >= old)
        return F.when(wins, F.col(f"_new.`{column}`")).otherwise(F.col(f"`{column}`"))

    return _upsert(base, latest_per_key(_keyed(updates, keys), keys, order), keys, newer, plan)


def last_values_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key and column, the newest value that is not NULL."""
    newest = _order(order)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[
        F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), newest)).alias(c) for c in rest
    ]).select(*[F.col(f"`{c}`") for c in df.columns])


def merge_by_key(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str],
                 plan: str = FEW) -> DataFrame:
    """Upsert of fields: an update's values overwrite, its NULLs leave the old value."""
    if plan == MANY:
        rows = _together(base, updates, keys)
        values = last_values_per_key(rows, [*keys, ALONE], [IS_NEW, *order])
        return values.drop(ALONE, IS_NEW).select(*_columns(base, updates))

    def kept(column: str) -> Column:
        return F.coalesce(F.col(f"_new.`{column}`"), F.col(f"`{column}`"))

    return _upsert(base, last_values_per_key(_keyed(updates, keys), keys, order), keys, kept, plan)


def _keyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.dropna(subset=list(keys))


def _columns(base: DataFrame, updates: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in [*base.columns, *(c for c in updates.columns if c not in base.columns)]]


def _together(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base and updates in one; updates are marked, and base rows without a full key stay apart from each other."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(f"`{key}`").isNotNull()
    apart = F.when(whole, F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    old = _filled(base, updates).withColumns({ALONE: apart, IS_NEW: F.lit(False)})
    new = _keyed(_filled(updates, base), keys).withColumns({ALONE: F.lit(-1).cast("long"), IS_NEW: F.lit(True)})
    return old.unionByName(new)


def _filled(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The rows with the columns only ``like`` has, as NULL."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in like.schema.fields if f.name not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def _upsert(base: DataFrame, folded: DataFrame, keys: Sequence[str],
            pick: Callable[[str], Column], plan: str) -> DataFrame:
    """Base (one row per key) with folded updates (one row per key) applied.

    Written as a left join plus the keys that are new, not as a full outer join:
    the usual case is a large base and few updates, and then the small side of
    every join here can be broadcast, so the base is neither shuffled nor sorted.
    The engine decides that by size; with large updates all are sort-merge joins.
    """
    base, folded = _filled(base, folded), _filled(folded, base)
    rest = [c for c in base.columns if c not in keys]
    new = folded.select(*keys, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_new"))
    if plan == BUCKETED:
        both = base.join(new, list(keys), "full")
        return both.select(*keys, *[pick(c).alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in base.columns])
    updated = base.join(new, list(keys), "left").select(*keys, *[pick(c).alias(c) for c in rest])
    known = base.select(*keys).join(folded.select(*keys), list(keys), "left_semi")
    added = folded.join(known, list(keys), "left_anti")
    return updated.unionByName(added).select(*[F.col(f"`{c}`") for c in base.columns])
