"""Idempotent merges written as joins.

A NULL key never matches. Rows with one go round the joins, so they never meet in
the task of the NULL hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.keys import whole_key

_HIT = "__hit"


def _held_keys(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Whole keys of the target that the updates ask for. Few updates are broadcast against it
    by the planner, so that only the keys they share leave the scan of a large target."""
    held = target.where(whole_key(*keys)).select(*keys)
    return held.join(updates.select(*keys), keys, "left_semi")


def within_range_of(target: DataFrame, updates: DataFrame, column: str) -> DataFrame:
    """Target rows inside the value range of ``updates[column]``.

    The limits are one scalar subquery, so they reach the scan of the target as
    filters: a day's merge does not read the whole history.
    """
    ends = updates.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("ends")).scalar()
    return target.where((F.col(column) >= ends["low"]) & (F.col(column) <= ends["high"]))


def rows_to_insert(
    target: DataFrame, updates: DataFrame, keys: list[str], range_key: str | None = None
) -> DataFrame:
    """Updates whose key the target does not hold.

    Duplicate new keys and rows with a NULL key all stay. ``range_key``, one of
    the keys, restricts how much of the target is read.
    """
    if range_key is not None:
        target = within_range_of(target, updates, range_key)
    whole = updates.where(whole_key(*keys))
    new = whole.join(_held_keys(target, whole, keys), keys, "left_anti")
    return new.select(*updates.columns).unionByName(updates.where(~whole_key(*keys)))


def insert_only_merge(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the new rows of ``updates``; matched rows keep their values."""
    new = rows_to_insert(target, updates, keys)
    return target.unionByName(new.select(*target.columns))


def one_per_key(
    source: DataFrame,
    keys: list[str],
    values: list[str],
    prefer: list[Column] | None = None,
    on_duplicate: str = "first",
) -> DataFrame:
    """One source row per key, picked by the smallest ``prefer`` (then values).

    Done with an aggregate that combines map-side, so one key holding most rows
    costs no single task. ``on_duplicate='error'`` marks groups of several rows
    with ``__many`` for the caller to refuse.
    """
    if on_duplicate not in ("first", "error"):
        raise ValueError("on_duplicate must be 'first' or 'error'")
    order = [c.alias(f"o{i}") for i, c in enumerate(prefer or [])]
    pick = F.min(F.struct(*order, F.struct(*values).alias("row"))).alias("__pick")
    grouped = source.where(whole_key(*keys)).groupBy(*keys)
    picked = grouped.agg(pick, (F.count(F.lit(1)) > 1).alias("__many"))
    flat = picked.select(*keys, "__pick.row.*", "__many")
    return flat if on_duplicate == "error" else flat.drop("__many")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    values: list[str],
    unique_source: bool = False,
    prefer: list[Column] | None = None,
    on_duplicate: str = "first",
) -> DataFrame:
    """Target after an update of matched rows and an insert of unmatched ones.

    A matched source NULL overwrites. Unmatched source rows are all inserted, also
    duplicates. The update side is reduced to one row per key and joined to the target,
    and the inserts come from an anti join: both are joins that adaptive execution can
    split on a busy key. ``unique_source`` promises one source row per key; a key that
    comes twice is then refused. Rows with a NULL key go round the joins.
    """
    columns = target.columns
    given = source.select(*keys, *values)
    latest = one_per_key(source, keys, values, prefer, "error" if unique_source else on_duplicate)
    if unique_source:
        twice = F.raise_error(F.lit("several source rows have one key")).cast("boolean")
        latest = latest.where(F.when(F.col("__many"), twice).otherwise(True)).drop("__many")
        given = latest.unionByName(given.where(~whole_key(*keys)))
    refusing = "__many" in latest.columns
    s = latest.select(
        *keys,
        *[F.col(v).alias(f"__s_{v}") for v in values],
        (F.col("__many") if refusing else F.lit(False)).alias("__many"),
        F.lit(True).alias(_HIT),
    )
    refused = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    hit = F.when(F.col("__many"), refused).otherwise(F.col(_HIT))
    matched = target.where(whole_key(*keys)).join(s, keys, "left")
    updated = matched.select(
        *[
            F.when(hit, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in columns
        ]
    ).unionByName(target.where(~whole_key(*keys)))
    inserted = rows_to_insert(target, given, keys)
    return updated.unionByName(inserted, allowMissingColumns=True).select(*columns)


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the distinct source rows whose key it does not hold."""
    new = rows_to_insert(target, source.select(*target.columns).distinct(), keys)
    return target.unionByName(new)
