"""Numbering, running totals, exact quantiles and top-n without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.staging import materialise

_PART = "__part"
_RUN = "__run"


def running_total(df: DataFrame, order: list[str], amount: Column, into: str) -> DataFrame:
    """Running sum of ``amount`` over the whole frame in the given order.

    Range partitions are written down with their partition number. Each is summed
    on its own, and the sums of the partitions before it (one row per partition)
    are added. ``order`` should be unique; equal rows share no single task as long
    as the full order differs.
    """
    parts = materialise(
        df.withColumn(_RUN, amount)
        .repartitionByRange(*[F.col(c) for c in order])
        .withColumn(_PART, F.spark_partition_id())
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.groupBy(_PART)
        .agg(F.sum(_RUN).alias("__sum"))
        .select(_PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    )
    inside = (
        Window.partitionBy(_PART)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        parts.withColumn(into, F.sum(_RUN).over(inside))
        .join(F.broadcast(starts), _PART)  # one row per shuffle partition
        .withColumn(into, F.col(into) + F.col("__start"))
        .drop(_PART, _RUN, "__start")
    )


def surrogate_ids(df: DataFrame, order: list[str], into: str) -> DataFrame:
    """Consecutive ids from 1 in the given order."""
    return running_total(df, order, F.lit(1).cast("long"), into)


def stable_ids(keys: DataFrame, known: DataFrame, on: list[str], into: str) -> DataFrame:
    """Ids for keys that ``known`` (the key columns and ``into``) does not hold yet.

    They follow the largest known id in the order of the keys, so ids that were given stay
    whatever is added or missing later. Keys that hold a NULL get none. One row per new key; append
    them to the map that ``known`` was read from.
    """
    fresh = keys.select(*on).dropna().distinct().join(known.select(*on), on, "left_anti")
    largest = known.agg(F.coalesce(F.max(into), F.lit(0))).scalar()
    numbered = surrogate_ids(fresh, on, "__rank")
    kind = known.schema[into].dataType
    return numbered.select(*on, (F.col("__rank") + largest).cast(kind).alias(into))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    """One row of order statistics: the smallest value covering each share.

    NULLs are left out; an empty input gives NULLs. Values are counted first (map-side
    combine), then a running total over the distinct values finds every share at once.
    """
    known = df.select(value).where(F.col(value).isNotNull())
    counts = materialise(known.groupBy(value).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    covered = running_total(counts, [value], F.col("n"), "upto")
    return covered.agg(
        *[
            F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * total), F.col(value))).alias(name)
            for name, p in probs.items()
        ]
    )


def sketch_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], accuracy: int
) -> DataFrame:
    """One row of approximate order statistics, rank error ``1 / accuracy``."""
    return df.agg(
        *[F.percentile_approx(value, p, accuracy).alias(name) for name, p in probs.items()]
    )


def nth_largest(df: DataFrame, value: str, n: int) -> DataFrame:
    """One row, one column ``cut``: the n-th largest known value (or the least)."""
    return (
        df.select(value)
        .where(F.col(value).isNotNull())
        .orderBy(F.desc(value))
        .limit(n)
        .agg(F.min(value).alias("cut"))
    )


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value is among the n largest; ties at the edge all stay."""
    return df.where(F.col(value) >= nth_largest(df, value, n).scalar())


def top_with_ties_by(df: DataFrame, by: list[str], value: str, n: int) -> DataFrame:
    """Per group of ``by`` the rows whose value is among the group's n largest, ties at the edge
    included. Unknown values are left out.

    The n-th value of a group is found among each task's n largest of it, so a group's rows, or its
    ties, never meet in one task; the rows are then compared with that value. ``df`` is read twice:
    pass a table. Groups of a NULL key are groups like others.
    """
    known = df.where(F.col(value).isNotNull())
    best = Window.partitionBy(*by).orderBy(F.desc(value))
    kept = known.select(*by, value).withColumn("__row", F.row_number().over(best)).where(F.col("__row") <= n)
    cuts = kept.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.min(value).alias("__cut"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return known.join(cuts, same & (F.col(value) >= F.col("__cut"))).select(*df.columns)


def latest_years(df: DataFrame, n: int, year: str = "year") -> DataFrame:
    """Rows of the n most recent distinct years."""
    return df.where(F.col(year) >= nth_largest(df.select(year).distinct(), year, n).scalar())
