"""The driver's tables seen as the engine's inputs.

Nations stand for countries, region 3 for the union, shipped quantities for
production and consumption, events for weekly prices. Some values are blanked by a
rule on nation and year so that missing data is always part of a run.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.staging import materialise
from tradewind.plans import market as M
from tradewind.plans.cleaning import clean_distance

UNION_REGION = 3
LATE = ("NATION_1", "NATION_12", "NATION_20")
ANCHOR = "NATION_3"
UNKNOWN_REPORTER = 11
OUTSIDER = 9
EARLIEST_YEAR = 1996
AS_OF = dt.date(2001, 12, 31)
MONEY = "decimal(18,2)"


class Inputs:
    """Readers and derived inputs of one scale factor; nothing is kept between queries."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def country_list(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_name").alias("iso3"), F.col("n_name").alias("name"), "n_regionkey"
        )

    @cached_property
    def countries(self) -> DataFrame:
        return materialise(
            M.country_dimension(self.country_list, F.col("n_regionkey") == UNION_REGION, LATE)
        )

    @cached_property
    def partners(self) -> DataFrame:
        return M.partners(self.countries)

    @cached_property
    def order_places(self) -> DataFrame:
        """Order key, customer nation and year."""
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                "o_orderkey",
                "c_nationkey",
                F.year("o_orderdate").alias("order_year"),
                "o_totalprice",
            )
        )

    @cached_property
    def flows(self) -> DataFrame:
        """Goods moved between nations per year: the one pass over the line items that
        production, consumption, imports, tariffs and distances all rest on."""
        shipped = (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                "l_orderkey",
                "s_nationkey",
                F.year("l_shipdate").alias("ship_year"),
                "l_quantity",
                F.col("l_tax").cast(MONEY).alias("tax"),
            )
        )
        return materialise(
            shipped.join(
                self.order_places.drop("o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey")
            )
            .groupBy("c_nationkey", "s_nationkey", "order_year", "ship_year")
            .agg(
                F.sum("l_quantity").alias("qty"),
                F.sum("tax").alias("tax"),
                F.count(F.lit(1)).alias("n"),
            )
        )

    def _yearly(self, values: DataFrame, value: str, blank: Column) -> DataFrame:
        """(nationkey, year, value) to entity, code, year, value; the code of one nation
        is in no country list."""
        nation = self.table("nation")
        listed = F.when(F.col("n_nationkey") == OUTSIDER, F.concat(F.lit("AGG_"), "n_name"))
        return values.join(nation, F.col("nationkey") == F.col("n_nationkey")).select(
            F.col("n_name").alias("entity"),
            listed.otherwise(F.col("n_name")).alias("code"),
            "year",
            F.when(~blank, F.col(value)).alias(value),
        )

    @cached_property
    def production(self) -> DataFrame:
        made = self.flows.groupBy(
            F.col("s_nationkey").alias("nationkey"), F.col("ship_year").alias("year")
        ).agg(F.sum("qty").alias("production_tonnes"))
        blank = (F.col("nationkey") + F.col("year")) % 7 == 0
        return self._yearly(made, "production_tonnes", blank)

    @cached_property
    def consumption(self) -> DataFrame:
        used = self.flows.groupBy(
            F.col("c_nationkey").alias("nationkey"), F.col("order_year").alias("year")
        ).agg(F.sum("qty").cast("long").alias("consumption_tones"))
        blank = (F.col("nationkey") + F.col("year")) % 5 == 0
        return self._yearly(used, "consumption_tones", blank)

    @cached_property
    def imports(self) -> DataFrame:
        bought = (
            self.flows.where(F.col("c_nationkey") != F.col("s_nationkey"))
            .groupBy(F.col("c_nationkey").alias("nationkey"), F.col("order_year").alias("year"))
            .agg(F.sum("qty").alias("import_tonnes"))
        )
        blank = (3 * F.col("nationkey") + F.col("year")) % 11 == 0
        return self._yearly(bought, "import_tonnes", blank)

    @cached_property
    def gdp(self) -> DataFrame:
        means = (
            self.order_places.groupBy(
                F.col("c_nationkey").alias("nationkey"), F.col("order_year").alias("year")
            )
            .agg(
                F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"),
                F.count(F.lit(1)).alias("n"),
            )
            .select(
                "nationkey",
                "year",
                (F.col("total").cast("double") / F.col("n")).alias("gdp_change_forecast"),
            )
        )
        blank = (F.col("nationkey") + F.col("year")) % 4 == 0
        return self._yearly(means, "gdp_change_forecast", blank)

    @cached_property
    def tariff(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        lines = self.flows.groupBy(
            "c_nationkey", "s_nationkey", F.col("order_year").alias("year")
        ).agg((F.sum("tax").cast("double") / F.sum("n")).alias("tariff_average"))
        reporter = nation.select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.when(F.col("n_nationkey") == UNKNOWN_REPORTER, "UNLISTED")
            .otherwise(F.col("n_name"))
            .alias("reporting_country_iso3"),
        )
        partner = nation.select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("partner_country_iso3")
        )
        return (
            lines.join(reporter, "c_nationkey")
            .join(partner, "s_nationkey")
            .select(
                "reporting_country_iso3", "partner_country_iso3", "year", "tariff_average"
            )
        )

    @cached_property
    def raw_distance(self) -> DataFrame:
        """Distance texts of every pair of nations that ever traded; '.' within one."""
        nation = self.table("nation").select("n_nationkey", "n_name")
        steps = F.abs(F.col("c_nationkey") - F.col("s_nationkey"))
        return (
            self.flows.select("c_nationkey", "s_nationkey")
            .distinct()
            .join(nation.withColumnsRenamed({"n_nationkey": "c_nationkey", "n_name": "iso_o"}), "c_nationkey")
            .join(nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "iso_d"}), "s_nationkey")
            .select(
                "iso_o",
                "iso_d",
                F.when(steps == 0, ".").otherwise((steps * 100 + 7).cast("string")).alias("dist"),
            )
        )

    @cached_property
    def trade(self) -> DataFrame:
        """Line items as trade lines."""
        seller = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select("s_suppkey", F.col("n_name").alias("member_state"))
        buyer = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", F.concat_ws(" ", "n_name", "c_mktsegment").alias("partner"))
        goods = self.table("part").select("p_partkey", F.col("p_type").alias("product_group"))
        bought = self.table("orders").join(buyer, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", "partner"
        )
        return (
            self.table("lineitem")
            .join(goods, F.col("l_partkey") == F.col("p_partkey"))
            .join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.when(F.col("l_returnflag") == "R", "export")
                .when(F.col("l_returnflag") == "A", "import")
                .otherwise("other")
                .alias("flow"),
                F.year("l_shipdate").alias("marketing_year"),
                F.month("l_shipdate").alias("month_order"),
                "member_state",
                "partner",
                "product_group",
                F.col("l_partkey").cast("string").alias("product_code"),
                F.col("l_quantity").alias("product_weight_in_tonnes"),
                (F.col("l_quantity") * 1.25).alias("carcase_weight_in_tonnes"),
                F.col("l_extendedprice").cast(MONEY).alias("value_in_thousand_euro"),
            )
        )

    @cached_property
    def raw_prices(self) -> DataFrame:
        """Weekly highest event values per nation as landed price texts."""
        nations = self.table("nation").select("n_nationkey", "n_name")
        weekly = (
            self.table("events")
            .select(
                (F.col("user_id") % 25).cast("int").alias("n_nationkey"),
                F.date_trunc("week", "ts").cast("date").alias("begin"),
                F.col("event_type").alias("pigClass"),
                "value",
            )
            .groupBy("n_nationkey", "begin", "pigClass")
            .agg(F.max("value").alias("value"))
        )
        return weekly.join(nations, "n_nationkey").select(
            F.col("n_nationkey").cast("string").alias("memberStateCode"),
            F.col("n_name").alias("memberStateName"),
            F.date_format("begin", "dd/MM/yyyy").alias("beginDate"),
            F.date_format(F.date_add("begin", 6), "dd/MM/yyyy").alias("endDate"),
            F.concat(F.lit("€"), F.col("value").cast(MONEY).cast("string")).alias("price"),
            F.lit("€/100 kg").alias("unit"),
            F.weekofyear("begin").alias("weekNumber"),
            "pigClass",
        )

    @cached_property
    def raw_production(self) -> DataFrame:
        """Monthly shipped quantities per supplier nation in landed form."""
        seller = self.table("supplier").select("s_suppkey", "s_nationkey")
        monthly = (
            self.table("lineitem")
            .join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("s_nationkey", F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("m"))
            .agg(F.count(F.lit(1)).cast("double").alias("heads"), F.sum("l_quantity").alias("tonnes"))
        )
        return monthly.join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("s_nationkey").cast("string").alias("memberStateCode"),
            F.col("n_name").alias("memberStateName"),
            F.date_format("m", "MMMM").alias("month"),
            F.year("m").alias("year"),
            "heads",
            (F.col("tonnes") / F.col("heads")).alias("kgPerHead"),
            "tonnes",
        )

    # The market model.

    @cached_property
    def fact_production(self) -> DataFrame:
        return M.yearly_fact(self.production, self.countries, "production_tonnes")

    @cached_property
    def fact_consumption(self) -> DataFrame:
        return M.yearly_fact(self.consumption, self.countries, "consumption_tones")

    @cached_property
    def fact_import(self) -> DataFrame:
        return M.yearly_fact(self.imports, self.countries, "import_tonnes")

    @cached_property
    def market(self) -> DataFrame:
        return M.market(self.fact_production, self.fact_import, self.fact_consumption)

    @cached_property
    def forecast(self) -> DataFrame:
        return M.gdp_forecast(self.gdp, self.countries)

    @cached_property
    def cagr(self) -> DataFrame:
        return M.import_growth(self.fact_import, earliest=EARLIEST_YEAR)

    @cached_property
    def growth(self) -> DataFrame:
        return M.growth(self.forecast, self.cagr)

    @cached_property
    def tariff_pairs(self) -> DataFrame:
        return M.tariff_pairs(self.tariff, self.countries)

    @cached_property
    def tariff_level(self) -> DataFrame:
        return M.tariff_level(self.tariff_pairs)

    @cached_property
    def distance_level(self) -> DataFrame:
        cleaned = clean_distance(self.raw_distance)
        return M.distance_level(M.distance_pairs(cleaned, self.countries, ANCHOR))

    @cached_property
    def barriers(self) -> DataFrame:
        return M.trade_barriers(self.tariff_level, self.distance_level)
