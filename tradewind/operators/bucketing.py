"""Keep the biggest groups by name, call the rest 'Other'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.ordering import nth_largest
from tradewind.operators.staging import materialise


def biggest_or_other(
    df: DataFrame,
    group: str,
    amount: str,
    keep: int = 7,
    recent: Column | None = None,
    into: str = "country_group",
    other: str = "Other",
) -> DataFrame:
    """One row per group of ``df`` (restricted to ``recent`` rows) with its label.

    A group keeps its name when its rank by total, ties sharing a rank, is at most
    ``keep``. The cut is found by a distributed top-n, not by ordering all groups
    in one task. Groups without a known total rank after all others.
    """
    rows = df if recent is None else df.where(recent)
    totals = materialise(
        rows.groupBy(group).agg(
            F.coalesce(F.sum(amount), F.lit(float("-inf"))).alias("__total")
        )
    )
    cut = nth_largest(totals, "__total", keep).scalar()
    label = F.when(F.col("__total") >= cut, F.col(group)).otherwise(F.lit(other))
    return totals.select(group, label.alias(into))
