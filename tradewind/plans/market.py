"""The market model: countries, yearly facts, growth and trade barriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.numbers import both_or_null
from tradewind.operators.growth import windowed_cagr
from tradewind.operators.lookup import with_country_id
from tradewind.operators.ordering import surrogate_ids
from tradewind.operators.scaling import minmax_by, minmax_overall, winsorised_minmax
from tradewind.operators.staging import materialise
from tradewind.schemas import MARKET
from tradewind.sources import reference, tables

# Countries whose figures arrive one year late.
LATE_REPORTERS = (
    "BEN", "BDI", "CAF", "TCD", "DMA", "JPN", "MLI", "SOM", "SSD", "SDN", "TGO",
)


def country_dimension(
    countries: DataFrame,
    is_eu: Column,
    late: tuple[str, ...] = LATE_REPORTERS,
    ids: DataFrame | None = None,
) -> DataFrame:
    """All countries ``(iso3, name)`` with flags and ids: those of a map ``(iso3, country_id)``, or
    new ones in code order."""
    flagged = countries.select(
        "iso3",
        "name",
        F.when(is_eu, 1).otherwise(0).alias("is_eu"),
        F.when(F.col("iso3").isin(*late), 1).otherwise(0).alias("faostat_fallback"),
    )
    if ids is not None:
        return flagged.join(ids, "iso3").select("iso3", "name", "is_eu", "faostat_fallback", "country_id")
    numbered = surrogate_ids(flagged, ["iso3", "name"], "country_id")
    return numbered.withColumn("country_id", F.col("country_id").cast("int"))


def partners(countries: DataFrame) -> DataFrame:
    """Possible export markets: countries outside the union."""
    return countries.where("is_eu = 0").select("country_id", "iso3", "name", "faostat_fallback")


def union_countries(countries: DataFrame) -> DataFrame:
    return countries.where("is_eu = 1").select("country_id", "iso3", "name")


def yearly_fact(table: DataFrame, countries: DataFrame, value: str) -> DataFrame:
    """Country-year values by country id; codes that are no country drop out."""
    known = with_country_id(table.select("code", "year", value), countries, "code")
    return known.select("country_id", "year", value)


def market(production: DataFrame, imports: DataFrame, consumption: DataFrame) -> DataFrame:
    """The three facts side by side, with the gap and both scaled measures.

    The joined table is written once: the scaling reads it for the extremes of a
    year and again for the rows.
    """
    on = ["country_id", "year"]
    joined = (
        production.join(imports, on, "full")
        .join(consumption, on, "full")
        .withColumn("import_gap", both_or_null("consumption_tones", "production_tonnes"))
    )
    return minmax_by(
        materialise(joined),
        {
            "import_gap": "import_gap_normalized",
            "import_tonnes": "import_size_normalized",
        },
        "year",
    )


def gdp_forecast(gdp: DataFrame, countries: DataFrame) -> DataFrame:
    """Mean forecast growth per country, scaled over all countries."""
    known = yearly_fact(gdp, countries, "gdp_change_forecast").where(
        F.col("gdp_change_forecast").isNotNull()
    )
    means = known.groupBy("country_id").agg(
        F.avg("gdp_change_forecast").alias("gdp_forecast_growth_avg"),
        F.count("gdp_change_forecast").alias("n_years"),
    )
    return minmax_overall(
        materialise(means), {"gdp_forecast_growth_avg": "gdp_growth_forecast_normalized"}
    )


def import_growth(
    imports: DataFrame,
    earliest: int = 2017,
    lower: float = 0.06,
    accuracy: int | None = None,
) -> DataFrame:
    """Windowed growth per country, lower tail winsorised, then scaled."""
    return winsorised_minmax(
        materialise(windowed_cagr(imports, "import_tonnes", earliest=earliest)),
        "import_CAGR",
        "import_CAGR_normalized",
        lower=lower,
        accuracy=accuracy,
    )


def growth(forecast: DataFrame, cagr: DataFrame) -> DataFrame:
    return forecast.join(cagr, "country_id", "full")


def tariff_pairs(tariff: DataFrame, countries: DataFrame) -> DataFrame:
    """Tariff lines towards union members; an unknown reporter keeps a NULL id."""
    members = countries.where("is_eu != 0")
    to_members = with_country_id(
        tariff.select("reporting_country_iso3", "partner_country_iso3", "year", "tariff_average"),
        members,
        "partner_country_iso3",
        "partner_country_id",
    )
    both = with_country_id(
        to_members, countries, "reporting_country_iso3", "reporting_country_id", True
    )
    return both.select(
        "reporting_country_id", "partner_country_id", "year", "tariff_average"
    )


def tariff_level(
    pairs: DataFrame, upper: float = 0.98, accuracy: int | None = None
) -> DataFrame:
    """Mean tariff per reporter, upper tail winsorised, then scaled."""
    means = pairs.groupBy(F.col("reporting_country_id").alias("country_id")).agg(
        F.avg("tariff_average").alias("tariff_avg")
    )
    return winsorised_minmax(
        materialise(means), "tariff_avg", "tariff_avg_normalized", upper=upper, accuracy=accuracy
    )


def distance_pairs(distance: DataFrame, countries: DataFrame, anchor: str) -> DataFrame:
    """Distances from one country, given by code, to the possible markets."""
    from_anchor = distance.where(F.col("iso_o") == anchor).select("iso_o", "iso_d", "dist")
    located = with_country_id(from_anchor, countries, "iso_o", "country_id_o")
    markets = countries.where("is_eu = 0")
    return with_country_id(located, markets, "iso_d", "country_id_d").select(
        "country_id_o", "country_id_d", "dist"
    )


def distance_level(pairs: DataFrame) -> DataFrame:
    """Distances scaled over the destinations."""
    return minmax_overall(materialise(pairs), "dist")


def trade_barriers(tariffs: DataFrame, distances: DataFrame) -> DataFrame:
    by_destination = distances.drop("country_id_o").withColumnRenamed("country_id_d", "country_id")
    return tariffs.join(by_destination, "country_id", "full")


def run_market(
    spark: SparkSession,
    silver: str,
    database: str,
    country_list: DataFrame,
    is_eu: Column,
    anchor: str,
    accuracy: int | None = None,
) -> None:
    """Fill the market model of a database from the cleaned tables of another."""

    def source(name: str) -> DataFrame:
        return spark.table(f"{silver}.{name}")

    def save(df: DataFrame, name: str) -> DataFrame:
        tables.overwrite_table(df, f"{database}.{name}", MARKET[name])
        return spark.table(f"{database}.{name}")

    ids = tables.refresh_ids(country_list, f"{database}.country_ids", MARKET["country_ids"], ["iso3"], "country_id")
    countries = materialise(country_dimension(country_list, is_eu, ids=ids))
    save(reference.calendar(spark), "dim_calendar")
    save(partners(countries), "dim_partner")
    save(union_countries(countries), "dim_ue_country")
    produced = save(
        yearly_fact(source("production"), countries, "production_tonnes"), "fact_production"
    )
    imported = save(yearly_fact(source("import"), countries, "import_tonnes"), "fact_import")
    consumed = save(
        yearly_fact(source("consumption"), countries, "consumption_tones"), "fact_consumption"
    )
    save(market(produced, imported, consumed), "fact_pork_market")
    save(
        yearly_fact(source("gdp_growth"), countries, "gdp_change_forecast").where(
            F.col("gdp_change_forecast").isNotNull()
        ),
        "fact_gdp_growth_forecast",
    )
    save(
        growth(
            gdp_forecast(source("gdp_growth"), countries),
            import_growth(imported, accuracy=accuracy),
        ),
        "fact_pork_market_growth",
    )
    pairs = save(tariff_pairs(source("tariff"), countries), "fact_tariff")
    distances = save(distance_pairs(source("distance"), countries, anchor), "fact_distance")
    save(
        trade_barriers(tariff_level(pairs, accuracy=accuracy), distance_level(distances)),
        "fact_trade_barriers",
    )
