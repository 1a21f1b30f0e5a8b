"""Questions asked of the market model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import scoring
from tradewind.operators.lookup import latest_values
from tradewind.operators.ordering import latest_years, top_with_ties, top_with_ties_by
from tradewind.operators.scoring import Weights


def indicators(
    partners: DataFrame, market: DataFrame, growth: DataFrame, barriers: DataFrame
) -> DataFrame:
    """One row per partner with the six indicators, raw and scaled.

    Rows of other countries, and of unknown reporters, find no partner.
    """
    latest = latest_values(
        market,
        partners,
        {
            "import_tonnes": "import_size",
            "import_gap": "import_gap",
            "import_size_normalized": "size_n",
            "import_gap_normalized": "gap_n",
        },
    )
    grown = growth.groupBy("country_id").agg(
        F.max("import_CAGR").alias("import_CAGR"),
        F.max("gdp_forecast_growth_avg").alias("gdp_forecast_growth_avg"),
        F.max("import_CAGR_normalized").alias("cagr_n"),
        F.max("gdp_growth_forecast_normalized").alias("gdp_n"),
    )
    held = barriers.groupBy("country_id").agg(
        F.max("tariff_avg").alias("tariff_avg"),
        F.max("dist").alias("dist"),
        F.max("tariff_avg_normalized").alias("tariff_n"),
        F.max("dist_normalized").alias("dist_n"),
    )
    return (
        partners.select("country_id", "iso3", "name")
        .join(latest, "country_id", "left")
        .join(grown, "country_id", "left")
        .join(held, "country_id", "left")
    )


def scores(rows: DataFrame, weights: list[Weights] | None = None) -> DataFrame:
    """Score every partner under every set of weights in one job."""
    return scoring.score_tree(scoring.with_scenarios(rows, weights or [Weights()]))


def best_markets(scored: DataFrame, n: int = 12) -> DataFrame:
    """The n best partners, ties at the edge included, best first."""
    return top_with_ties(scored.select("country_id", "name", "market_score"), "market_score", n)


def best_of_scenarios(scored: DataFrame, n: int = 12) -> DataFrame:
    """The n best partners of every scenario, ties at the edge included. ``scored`` is read twice."""
    columns = ["scenario", "country_id", "name", "market_score"]
    return top_with_ties_by(scored.select(*columns), ["scenario"], "market_score", n)


def partner_detail(breakdown: DataFrame, name: str) -> DataFrame:
    """Indicator rows of one partner in display order."""
    return breakdown.where(F.col("name") == name).orderBy("indicator_order")


def partner_card(scored: DataFrame, name: str) -> DataFrame:
    """Name and score of one partner; one row also when there is no such partner."""
    return scored.where(F.col("name") == name).agg(
        F.min("name").alias("name"), F.max("market_score").alias("market_score")
    )


def history(market: DataFrame, partners: DataFrame, value: str, n_years: int = 6) -> DataFrame:
    """Yearly sums of a measure per partner over the most recent years."""
    recent = latest_years(market, n_years).where(F.col(value).isNotNull())
    return (
        recent.join(partners.select("country_id", "name"), "country_id")
        .groupBy("name", "year")
        .agg(F.sum(value).alias(value))
    )


def diagnostic_table(rows: DataFrame, market: DataFrame, year: int) -> DataFrame:
    """Scaled size and gap, raw gap, and one year's consumption per partner.

    The year restricts consumption only; the others have their own year rule.
    """
    consumed = (
        market.where(F.col("year") == year)
        .groupBy("country_id")
        .agg(F.sum("consumption_tones").alias("consumption_tones"))
    )
    table = rows.join(consumed, "country_id", "left").select(
        "name",
        F.col("size_n").alias("import_size_normalized"),
        F.col("gap_n").alias("import_gap_normalized"),
        "import_gap",
        "consumption_tones",
    )
    some = F.coalesce(
        *[F.col(c).cast("double") for c in table.columns if c != "name"]
    ).isNotNull()
    return table.where(some).orderBy(F.desc_nulls_last("import_size_normalized"))
