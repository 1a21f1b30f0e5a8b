"""Small reference data: ranges, series and literal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.scoring import HIERARCHY, INDICATORS


def calendar(spark: SparkSession, first: int = 2018, last: int = 2030) -> DataFrame:
    """One row per year, both ends included."""
    return spark.range(first, last + 1).select(F.col("id").alias("year"))


def calendar_of(df: DataFrame, year: str = "year") -> DataFrame:
    """Every year between the first and last of a frame, gaps included."""
    ends = df.agg(F.min(year).alias("a"), F.max(year).alias("b"))
    return ends.select(
        F.explode(F.sequence(F.col("a").cast("long"), F.col("b").cast("long"))).alias("year")
    )


def slider_positions(spark: SparkSession, steps: int = 100) -> DataFrame:
    """Slider values 0 to 1, exact to the hundredth."""
    return spark.range(steps + 1).select((F.col("id") / steps).alias("value"))


def country_list(spark: SparkSession, path: str) -> DataFrame:
    """Country list from a CSV ``ISO3,name_short,EU``; any EU text marks a member."""
    raw = spark.read.option("header", True).schema("ISO3 string, name_short string, EU string").csv(path)
    return raw.select(
        F.col("ISO3").alias("iso3"),
        F.col("name_short").alias("name"),
        (F.coalesce(F.trim("EU"), F.lit("")) != "").alias("eu"),
    )


def indicator_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(name, order) for name, order in INDICATORS.items()], "Indicator string, Order bigint"
    )


def hierarchy_table(spark: SparkSession) -> DataFrame:
    """The weight tree with the display order of each level."""
    orders = {"Demand": 1, "Barriers": 2, "Trade": 1, "Growth": 2, "Tariff": 3, "Distance": 4}
    rows = [
        (a, b, c, orders[a], orders[b], INDICATORS[name]) for name, (a, b, c) in HIERARCHY.items()
    ]
    return spark.createDataFrame(
        rows,
        "`Group lvl 1` string, `Group lvl 2` string, Parameter string, "
        "`Lvl 1 order` bigint, `Lvl 2 order` bigint, `Lvl 3 order` bigint",
    )
