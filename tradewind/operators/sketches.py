"""Quantiles from stored sketches: a day's rows are read once, on the day they come.

A KLL sketch keeps some thousand values of a group, whatever its size, and two sketches merge into
that of all their rows. So sketches are stored per day and group, and quantiles over
any days come from merging them, without reading old rows. The rank of a quantile is off by about
``2.3 / k`` of the rows. Counts and extremes are kept beside, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.numbers import finite
from tradewind.sources.snapshots import NO_VALUE, Snapshot, SnapshotTable

K = 800


def value_sketches(df: DataFrame, by: list[str], value: str, k: int = K) -> DataFrame:
    """sketch, n, low and high of the finite values of each group."""
    number = finite(F.col(value).cast("double"))
    return df.groupBy(*by).agg(
        F.kll_sketch_agg_double(number, k).alias("sketch"),
        F.count(number).alias("n"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
    )


def merged_sketches(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """The sketch of all rows behind the sketches of a group. Groups without values are left out."""
    return sketches.where("n > 0").groupBy(*by).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def _quantile(p: float) -> Column:
    """The ends are the exact extremes."""
    if p <= 0.0:
        return F.col("low")
    if p >= 1.0:
        return F.col("high")
    # An empty sketch has no quantiles, and asking it fails.
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))


def quantiles_of(sketches: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Each row's quantiles by name in place of its sketch."""
    kept = [c for c in sketches.columns if c not in ("sketch", "low", "high")]
    return sketches.select(*kept, *[_quantile(p).alias(name) for name, p in probs.items()])


def limits_of(
    sketches: DataFrame, lower: float | None = None, upper: float | None = None, k: int = K
) -> DataFrame:
    """One row (low, high): quantiles over all rows behind the sketches, or their extremes."""
    # Without any values the row holds NULLs.
    whole = sketches.where("n > 0").agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    return whole.select(
        _quantile(lower or 0.0).alias("low"), _quantile(1.0 if upper is None else upper).alias("high")
    )


class SketchStore:
    """Sketches per day and group below a folder. ``groups`` names the group columns with their
    types, as in ``"state string, kind int"``."""

    def __init__(self, spark: SparkSession, root: str, groups: str, k: int = K) -> None:
        ddl = f"day string, {groups}, sketch binary, n bigint, low double, high double"
        self.table = SnapshotTable(spark, root, ddl, "day")
        self.k = k
        self.by = [c for c in spark.createDataFrame([], groups).columns]

    def add(self, rows: DataFrame, day: Column, value: str) -> Snapshot:
        """Sketch the rows of some days, which replace what is held for these days.

        A repeated call changes nothing but the choice of the kept values. One value per
        day is fetched, no rows.
        """
        dated = rows.withColumn("day", day.cast("string"))
        days = {NO_VALUE if r.day is None else r.day for r in dated.select("day").distinct().collect()}
        base = self.table.live()
        if not days:
            return base
        return self.table.renew(value_sketches(dated, ["day", *self.by], value, self.k), days, base, None)

    def merged(self, days: set[str] | None = None) -> DataFrame:
        """One sketch per group over all days, or over some: only their folders are read."""
        return merged_sketches(self.table.read(parts=days), self.by, self.k)
