"""Compound growth over each country's most recent years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.numbers import compound_growth


def windowed_cagr(
    df: DataFrame,
    value: str,
    key: str = "country_id",
    year: str = "year",
    span: int = 5,
    earliest: int = 2017,
    min_periods: int = 5,
    into: str = "import_CAGR",
) -> DataFrame:
    """Compound growth from the first to the last year of a trailing window.

    The window runs ``span`` years back from the key's own last year, not before
    ``earliest``. Keys with fewer than ``min_periods`` known values are left out.
    Rows are first combined per key and year (map side), so the window that finds
    the last year holds one row per calendar year however many rows a key has. A
    year given more than once contributes its largest value.
    """
    yearly = (
        df.where(F.col(year).isNotNull())
        .groupBy(key, year)
        .agg(F.max(value).alias("__value"), F.count(value).alias("__known"))
    )
    recent = yearly.withColumn("max_year", F.max(year).over(Window.partitionBy(key))).where(
        F.col(year) >= F.greatest(F.col("max_year") - span, F.lit(earliest))
    )
    ends = recent.groupBy(key).agg(
        F.min_by("__value", year).alias("__first"),
        F.max_by("__value", year).alias("__last"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.max("max_year").alias("max_year"),
        F.sum("__known").alias("n_periods_non_null"),
    )
    growth = compound_growth(
        F.col("__first"), F.col("__last"), F.col("last_year") - F.col("first_year")
    )
    return ends.where(F.col("n_periods_non_null") >= min_periods).select(
        key,
        growth.alias(into),
        "first_year",
        "last_year",
        "max_year",
        "n_periods_non_null",
    )
