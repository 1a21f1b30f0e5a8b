"""One query per operator, over the driver's whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import dates, keys, numbers
from tradewind.functions.aggregates import selected_value, summarize
from tradewind.operators import (
    bucketing,
    lookup,
    merge,
    ordering,
    quality,
    scaling,
    scoring,
    sketches,
    sliders,
)
from tradewind.operators.growth import windowed_cagr
from tradewind.operators.scoring import Weights
from tradewind.operators.staging import materialise, staging_root
from tradewind.plans import cleaning, reports, trade
from tradewind.plans import market as M
from tradewind.schemas import SILVER, conform
from tradewind.sources import landing, reference, tables
from tradewind.sources.ledger import RunLedger
from workload.inputs import AS_OF, EARLIEST_YEAR, LATE, MONEY, UNION_REGION, Inputs

Query = Callable[[Inputs], DataFrame]
REGISTRY: dict[str, Query] = {}

SCENARIOS = [
    Weights(scenario="default"),
    Weights(0.5, 0.5, 0.5, 0.5, 0.5, "even"),
    Weights(1.0, 0.5, 0.5, 1.0, 1.0, "demand only"),
    Weights(0.0, 0.5, 0.25, 0.5, 0.5, "ease only"),
    Weights(0.6, 0.2, 0.75, 0.3, 0.4, "growth first"),
]
CUT_OLD = "1999-07-01"
CUT_NEW = "1998-07-01"


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, negative zero removed; decimals as doubles."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        if kind == "double" or kind.startswith("decimal"):
            c = F.round(c, places) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


# Dimensions.


@query
def dim_country(x: Inputs) -> DataFrame:
    return M.country_dimension(x.country_list, F.col("n_regionkey") == UNION_REGION, LATE)


@query
def dim_partner(x: Inputs) -> DataFrame:
    return x.partners


@query
def dim_ue_country(x: Inputs) -> DataFrame:
    return M.union_countries(x.countries)


@query
def dim_calendar(x: Inputs) -> DataFrame:
    return reference.calendar_of(x.table("orders").select(F.year("o_orderdate").alias("year")))


@query
def surrogate_key(x: Inputs) -> DataFrame:
    numbered = ordering.surrogate_ids(
        x.table("part").select("p_name", "p_partkey"), ["p_name", "p_partkey"], "part_id"
    )
    return numbered.select("part_id", "p_partkey")


def _second_load(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """The key map after two loads, each with keys that the other does not have."""
    none = first.select(*on, F.lit(None).cast("bigint").alias("id")).limit(0)
    known = materialise(ordering.stable_ids(first, none, on, "id"))
    return known.unionByName(ordering.stable_ids(second, known, on, "id"))


@query
def stable_country_ids(x: Inputs) -> DataFrame:
    n = x.table("nation")
    return _second_load(n.where("n_nationkey % 3 <> 0"), n.where("n_nationkey % 4 <> 1"), ["n_name"])


@query
def stable_part_ids(x: Inputs) -> DataFrame:
    """Part numbers of two loads by name and brand; the second has new ones and lacks old ones."""
    p = x.table("part")
    return _second_load(p.where("p_size <= 25"), p.where("p_size > 10"), ["p_brand", "p_name"])


# Yearly facts and the market table.


@query
def fact_production(x: Inputs) -> DataFrame:
    return x.fact_production


@query
def fact_consumption(x: Inputs) -> DataFrame:
    return x.fact_consumption


@query
def fact_import(x: Inputs) -> DataFrame:
    return x.fact_import


@query
def market(x: Inputs) -> DataFrame:
    return tidy(x.market)


@query
def minmax_by_year(x: Inputs) -> DataFrame:
    """Order totals scaled inside their year."""
    totals = x.table("orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice"
    )
    return tidy(scaling.minmax_by(totals, "o_totalprice", "year").drop("o_totalprice"))


@query
def minmax_global(x: Inputs) -> DataFrame:
    balances = x.table("customer").select("c_custkey", "c_acctbal")
    return tidy(scaling.minmax_overall(balances, {"c_acctbal": "scaled"}).drop("c_acctbal"))


@query
def winsor_low(x: Inputs) -> DataFrame:
    balances = x.table("customer").select("c_custkey", "c_acctbal")
    return tidy(scaling.winsorised_minmax(balances, "c_acctbal", "scaled", lower=0.06))


@query
def winsor_high(x: Inputs) -> DataFrame:
    totals = x.table("orders").select("o_orderkey", "o_totalprice")
    return tidy(scaling.winsorised_minmax(totals, "o_totalprice", "scaled", upper=0.98))


@query
def quantiles(x: Inputs) -> DataFrame:
    shares = {"q01": 0.01, "q06": 0.06, "q25": 0.25, "q75": 0.75, "q98": 0.98, "q99": 0.99}
    return ordering.exact_quantiles(x.table("lineitem"), "l_extendedprice", shares)


def _price_sketches(x: Inputs) -> tuple[DataFrame, DataFrame]:
    """Line items, and their prices' sketches by return flag, stored in two loads of whole years."""
    lines = x.table("lineitem").select("l_returnflag", F.year("l_shipdate").alias("year"), "l_extendedprice")
    store = sketches.SketchStore(
        x.spark, f"{staging_root(x.spark)}/sketches-{materialise_tag()}", "l_returnflag string"
    )
    for load in (lines.where("year < 1998"), lines.where("year >= 1998")):
        store.add(load, F.col("year"), "l_extendedprice")
    return lines, store.merged()


@query
def quantile_sketch_merged(x: Inputs) -> DataFrame:
    """Whether quantiles from stored sketches are within a hundredth of their rank over all rows."""
    shares = {"q06": 0.06, "q25": 0.25, "q75": 0.75, "q98": 0.98}
    lines, merged = _price_sketches(x)
    found = materialise(sketches.quantiles_of(merged, shares))
    value = F.col("l_extendedprice")
    counts = [
        c
        for q in shares
        for c in (F.count_if(value < F.col(q)).alias(f"{q}_below"), F.count_if(value <= F.col(q)).alias(f"{q}_upto"))
    ]
    ranked = lines.join(found, "l_returnflag").groupBy("l_returnflag", "n").agg(*counts)
    rows = [
        F.struct(
            F.lit(p).alias("share"),
            ((F.col(f"{q}_below") <= (p + 0.01) * F.col("n")) & (F.col(f"{q}_upto") >= (p - 0.01) * F.col("n")))
            .alias("within"),
        )
        for q, p in shares.items()
    ]
    return ranked.select("l_returnflag", "n", F.inline(F.array(*rows)))


@query
def extremes_from_sketches(x: Inputs) -> DataFrame:
    """Prices scaled between the extremes that the stored sketches hold, summed by flag."""
    lines, merged = _price_sketches(x)
    ends = materialise(sketches.limits_of(merged))
    scaled = scaling.winsorised_minmax(lines, "l_extendedprice", "scaled", given=ends)
    return tidy(scaled.groupBy("l_returnflag").agg(F.avg("scaled").alias("mean"), F.max("scaled").alias("most")))


@query
def gdp_growth(x: Inputs) -> DataFrame:
    return tidy(x.forecast)


@query
def cagr(x: Inputs) -> DataFrame:
    return tidy(windowed_cagr(x.fact_import, "import_tonnes", earliest=EARLIEST_YEAR))


@query
def growth(x: Inputs) -> DataFrame:
    return tidy(x.growth)


@query
def tariff_pairs(x: Inputs) -> DataFrame:
    return tidy(x.tariff_pairs)


@query
def tariff_avg(x: Inputs) -> DataFrame:
    return tidy(x.tariff_level)


@query
def distance(x: Inputs) -> DataFrame:
    return tidy(x.distance_level)


@query
def trade_barriers(x: Inputs) -> DataFrame:
    return tidy(x.barriers)


# Scores and reports.


def _indicators(x: Inputs) -> DataFrame:
    return reports.indicators(x.partners, x.market, x.growth, x.barriers)


SCORE_COLUMNS = [
    "country_id",
    "name",
    "growth_metric",
    "market_metric",
    "demand_metric",
    "ease_metric",
    "market_score",
]


@query
def latest_year_fallback(x: Inputs) -> DataFrame:
    wanted = {
        "import_tonnes": "import_size",
        "import_gap": "import_gap",
        "import_size_normalized": "size_n",
        "import_gap_normalized": "gap_n",
    }
    return tidy(lookup.latest_values(x.market, x.partners, wanted))


@query
def score(x: Inputs) -> DataFrame:
    return tidy(reports.scores(_indicators(x)).select(*SCORE_COLUMNS))


@query
def score_legacy(x: Inputs) -> DataFrame:
    return tidy(_indicators(x).select("country_id", "name", scoring.flat_score().alias("score")))


@query
def score_top12(x: Inputs) -> DataFrame:
    scored = materialise(reports.scores(_indicators(x)))
    return tidy(reports.best_markets(scored, 12))


@query
def score_scenarios(x: Inputs) -> DataFrame:
    scored = reports.scores(_indicators(x), SCENARIOS)
    return tidy(scored.select("scenario", *SCORE_COLUMNS))


@query
def top12_by_scenario(x: Inputs) -> DataFrame:
    scored = materialise(reports.scores(_indicators(x), SCENARIOS))
    return tidy(reports.best_of_scenarios(scored, 12))


@query
def ever_in_top12(x: Inputs) -> DataFrame:
    """Partners among the twelve best at any of the 3,125 settings in quarters."""
    return sliders.ever_in_top(_indicators(x), 12, steps=4)


@query
def top_lines_by_supplier(x: Inputs) -> DataFrame:
    """The three dearest line items of every supplier and return flag, ties kept."""
    lines = x.table("lineitem").select(
        "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return ordering.top_with_ties_by(lines, ["l_suppkey", "l_returnflag"], "l_extendedprice", 3)


@query
def score_slider(x: Inputs) -> DataFrame:
    """Every partner at each of the 101 positions of the demand slider."""
    weighted = scoring.with_scenarios(_indicators(x), [Weights()])
    moved = scoring.with_slider(weighted, "w_demand")
    scored = scoring.score_tree(moved)
    return tidy(scored.select("country_id", "w_demand", "demand_metric", "ease_metric"))


def _breakdown(x: Inputs) -> DataFrame:
    return scoring.indicator_breakdown(scoring.with_scenarios(_indicators(x), [Weights()]))


@query
def indicator_breakdown(x: Inputs) -> DataFrame:
    return tidy(
        _breakdown(x).select(
            "country_id",
            "indicator",
            "indicator_order",
            "value_normalized",
            "weight",
            "weighted_value",
        )
    )


@query
def indicator_text(x: Inputs) -> DataFrame:
    """Indicator values as text with units; the long fractions are cut to 2 places."""
    rounded = _indicators(x)
    for c in ("import_size", "import_gap", "dist"):
        rounded = rounded.withColumn(c, F.round(c, 2))
    weighted = scoring.with_scenarios(rounded, [Weights()])
    return scoring.indicator_breakdown(weighted).select("country_id", "indicator", "value_text")


@query
def indicator_shares(x: Inputs) -> DataFrame:
    return tidy(scoring.contribution_shares(materialise(_breakdown(x)), ["country_id"]))


@query
def partner_detail(x: Inputs) -> DataFrame:
    detail = reports.partner_detail(_breakdown(x), "NATION_2")
    return tidy(detail.select("name", "indicator", "weight", "weighted_value"))


@query
def partner_card(x: Inputs) -> DataFrame:
    return tidy(reports.partner_card(reports.scores(_indicators(x)), "NATION_2"))


@query
def weight_rollup(x: Inputs) -> DataFrame:
    by = ["country_id", "scenario"]
    weighted = scoring.with_scenarios(_indicators(x), SCENARIOS)
    broken = scoring.indicator_breakdown(materialise(weighted))
    weights = scoring.with_scenarios(x.partners.select("country_id"), SCENARIOS)
    return tidy(scoring.weight_rollup(broken, weights, by))


@query
def weight_texts(x: Inputs) -> DataFrame:
    """The score spelled out per partner and scenario."""
    weighted = scoring.with_scenarios(x.partners.select("country_id"), SCENARIOS)
    texts = [c.alias(n) for n, c in scoring.formula_texts().items()]
    return weighted.select("country_id", "scenario", *texts)


@query
def weight_splits(x: Inputs) -> DataFrame:
    weighted = scoring.with_scenarios(x.partners.select("country_id"), SCENARIOS)
    splits = [c.alias(n) for n, c in scoring.split_columns().items()]
    return tidy(weighted.select("country_id", "scenario", *splits))


@query
def barrier_weights(x: Inputs) -> DataFrame:
    weighted = scoring.with_scenarios(_indicators(x), SCENARIOS)
    shown = scoring.indicator_breakdown(weighted).select("country_id", "scenario", "indicator")
    weights = scoring.with_scenarios(x.partners.select("country_id"), SCENARIOS)
    return tidy(
        shown.join(weights, ["country_id", "scenario"]).select(
            "country_id",
            "scenario",
            "indicator",
            scoring.barrier_parameter_weight(F.col("indicator")).alias("weight"),
        )
    )


@query
def gap_year(x: Inputs) -> DataFrame:
    return lookup.gap_of_year(x.market, 1999, ["country_id"])


@query
def max_gap_year(x: Inputs) -> DataFrame:
    return lookup.largest_gap_of_year(x.market, 1999)


@query
def history_top6_years(x: Inputs) -> DataFrame:
    return reports.history(x.market, x.partners, "import_gap")


@query
def history_import(x: Inputs) -> DataFrame:
    return reports.history(x.market, x.partners, "import_tonnes")


@query
def diagnostic_table(x: Inputs) -> DataFrame:
    return tidy(reports.diagnostic_table(_indicators(x), x.market, 2000))


@query
def default_summary(x: Inputs) -> DataFrame:
    return tidy(summarize(x.market, ["year"]))


@query
def single_value(x: Inputs) -> DataFrame:
    """Per customer the one status of all their orders, if there is just one, and the
    first nation name of the group."""
    return x.table("orders").groupBy("o_custkey").agg(
        selected_value("o_orderstatus").alias("only_status"),
        F.min("o_orderpriority").alias("first_priority"),
    )


# Prices and the trade model.


@query
def price_weeks(x: Inputs) -> DataFrame:
    return cleaning.clean_prices(x.raw_prices, AS_OF)


@query
def majority_month(x: Inputs) -> DataFrame:
    """The month holding most days between order and shipping."""
    periods = (
        x.table("lineitem")
        .join(x.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("begin_date"),
            F.col("l_shipdate").cast("date").alias("end_date"),
        )
        .distinct()
    )
    return periods.withColumn("m", dates.majority_month("begin_date", "end_date")).select(
        "begin_date", "end_date", "m.year", "m.month_number"
    )


@query
def production_silver(x: Inputs) -> DataFrame:
    return tidy(cleaning.clean_production(x.raw_production, AS_OF))


@query
def trade_silver(x: Inputs) -> DataFrame:
    """All trade lines as two text extracts, exports and the rest, cleaned, then counted and summed
    per month. The lines are joined once and written; both extracts read them."""
    lines = x.trade.select(
        "flow",
        F.col("marketing_year").cast("string").alias("marketing_year"),
        F.date_format(F.make_date("marketing_year", "month_order", F.lit(1)), "MMMM").alias("month"),
        F.col("month_order").cast("string").alias("month_order"),
        F.concat_ws("-", "marketing_year", "month_order").alias("month_date"),
        "member_state",
        "partner",
        "product_group",
        "product_code",
        F.col("product_weight_in_tonnes").cast("string").alias("product_weight_in_tonnes"),
        F.col("carcase_weight_in_tonnes").cast("string").alias("carcase_weight_in_tonnes"),
        F.col("value_in_thousand_euro").cast("string").alias("value_in_thousand_euro"),
    ).withColumnsRenamed({v: k for k, v in cleaning.TRADE_NAMES.items()})
    texts = materialise(lines)
    is_export = F.col("Flow").eqNullSafe("export")
    exports, imports = texts.where(is_export), texts.where(~is_export)
    cleaned = cleaning.clean_trade(exports, imports, AS_OF)
    return cleaned.groupBy("flow", "marketing_year", "month_order", "month", "created").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("product_weight_in_tonnes").alias("weight"),
        F.sum(F.col("value_in_thousand_euro").cast(MONEY)).cast("double").alias("value"),
    )


@query
def trade_union(x: Inputs) -> DataFrame:
    """Export lines and all others put together by column name."""
    lines = materialise(x.trade.select("flow", "product_code", "partner"))
    is_export = F.col("flow").eqNullSafe("export")
    exports = lines.where(is_export)
    imports = lines.where(~is_export).select("partner", "flow", "product_code")
    both = exports.unionByName(imports)
    return both.groupBy("flow", "partner").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("product_code").alias("first_code")
    )


@query
def export_import_last_month(x: Inputs) -> DataFrame:
    return tidy(trade.trade_rows(x.trade))


@query
def fact_prices(x: Inputs) -> DataFrame:
    return trade.price_rows(cleaning.clean_prices(x.raw_prices, AS_OF), "purchase")


@query
def topn_else_other(x: Inputs) -> DataFrame:
    cleaned = cleaning.clean_production(x.raw_production, AS_OF)
    return bucketing.biggest_or_other(
        cleaned, "member_state_name", "tonnes", 7, recent=F.col("year") >= AS_OF.year - 4
    )


@query
def production_groups(x: Inputs) -> DataFrame:
    return tidy(trade.production_rows(cleaning.clean_production(x.raw_production, AS_OF), AS_OF))


def _model_rows(x: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    prices = trade.price_rows(cleaning.clean_prices(x.raw_prices, AS_OF), "purchase")
    made = trade.production_rows(cleaning.clean_production(x.raw_production, AS_OF), AS_OF)
    return trade.trade_rows(x.trade), prices, made


@query
def bridge_member_date(x: Inputs) -> DataFrame:
    return trade.bridge_rows(*_model_rows(x))


@query
def dim_date(x: Inputs) -> DataFrame:
    return trade.date_rows(trade.bridge_rows(*_model_rows(x)))


# Merges.


@query
def insert_only_merge(x: Inputs) -> DataFrame:
    """Older orders as the table, newer ones, with changed prices, as the updates.
    Some updates have no key and are always added."""
    orders = x.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    target = orders.where(F.col("o_orderdate") < CUT_OLD)
    updates = (
        orders.where(F.col("o_orderdate") >= CUT_NEW)
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
        .withColumn("o_custkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")))
    )
    return tidy(merge.insert_only_merge(target, updates, ["o_orderkey", "o_custkey"]))


@query
def merge_bucketed(x: Inputs) -> DataFrame:
    """Two loads of line items merged into a table that is bucketed by their key. The second has
    lines of the first with other prices, new ones, and some without a number, which are always added."""
    name = f"default.lines_{materialise_tag()}"
    ddl = "l_orderkey bigint, l_linenumber int, l_extendedprice double"
    keys_of = ["l_orderkey", "l_linenumber"]
    n = int(x.spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = tables.Buckets(n, tuple(keys_of))
    lines = x.table("lineitem")
    number = F.when(F.col("l_partkey") % 50 != 0, F.col("l_linenumber")).alias("l_linenumber")
    first = lines.where("l_orderkey % 3 <> 0").select("l_orderkey", number, "l_extendedprice")
    price = (F.col("l_extendedprice") + 1).alias("l_extendedprice")
    second = lines.where("l_orderkey % 4 <> 1").select("l_orderkey", number, price)
    folder = f"{staging_root(x.spark)}/{name.replace('.', '-')}"
    for load in (first, second):
        tables.merge_new_rows(load, name, ddl, keys_of, buckets=buckets, location=folder)
    return tidy(x.spark.table(name))


def _old_trade(rows: DataFrame) -> DataFrame:
    """An earlier state of the trade fact: some months, other values, and rows the
    source no longer has."""
    early = rows.where(F.right("trade_key", F.lit(7)) < "1998-01").withColumns(
        {
            "product_weight_in_tonnes": F.lit(-1.0),
            "value_in_thousand_euro": F.lit(None).cast("double"),
            "last_month": F.lit(0),
        }
    )
    gone = early.where(F.col("flow") == "other").withColumn(
        "trade_key", F.concat(F.lit("OLD "), "trade_key")
    )
    return early.unionByName(gone)


@query
def upsert_trade(x: Inputs) -> DataFrame:
    rows = materialise(
        trade.trade_rows(x.trade).withColumn(
            "value_in_thousand_euro", F.col("value_in_thousand_euro").cast("double")
        )
    )
    return tidy(
        merge.upsert(
            _old_trade(rows), rows, trade.TRADE_KEYS, trade.TRADE_VALUES, unique_source=True
        )
    )


def _dated_trade(x: Inputs) -> DataFrame:
    """Trade lines with the day they came: most on the first, a later year on the second, and
    late lines of every July on the third."""
    late = (F.col("month_order") == 7) & (F.col("product_code").cast("long") % 5 == 0)
    after = F.when(late, 2).when(F.col("marketing_year") >= 2000, 1).otherwise(0)
    created = F.date_add(F.lit(AS_OF), after)
    return materialise(x.trade.withColumn("created", created))


def _refreshed(x: Inputs, days: list[int]) -> DataFrame:
    lines = _dated_trade(x)
    sums = trade.trade_sums(x.spark, f"{staging_root(x.spark)}/sums-{materialise_tag()}")
    for after in days:
        day = AS_OF + dt.timedelta(days=after)
        trade.refresh_trade(lines.where(F.col("created") <= F.lit(day)), sums)
    return tidy(trade.trade_fact(sums))


@query
def trade_facts_incremental(x: Inputs) -> DataFrame:
    """The trade fact after three days of lines, each day's months summed again."""
    return _refreshed(x, [0, 1, 2])


@query
def upsert_trade_repeat(x: Inputs) -> DataFrame:
    """The trade fact after runs that were repeated and one that skipped a day."""
    return _refreshed(x, [0, 0, 2, 2])


@query
def upsert_prices(x: Inputs) -> DataFrame:
    rows = materialise(trade.price_rows(cleaning.clean_prices(x.raw_prices, AS_OF), "purchase"))
    old = rows.where(F.col("week_number") <= 2).withColumns(
        {"price": F.lit(0.0), "unit": F.lit(None).cast("string")}
    )
    return tidy(merge.upsert(old, rows, trade.PRICE_KEYS, trade.PRICE_VALUES))


@query
def upsert_production(x: Inputs) -> DataFrame:
    rows = materialise(
        trade.production_rows(cleaning.clean_production(x.raw_production, AS_OF), AS_OF)
    )
    old = rows.where(keys.month_of_key("prod_key") < "1999-01").withColumns(
        {"tonnes": F.lit(0.0), "country_group": F.lit("Unknown")}
    )
    return tidy(merge.upsert(old, rows, trade.PRODUCTION_KEYS, trade.PRODUCTION_VALUES))


@query
def upsert_one_per_key(x: Inputs) -> DataFrame:
    """Many line items per order: the earliest shipped one updates the row of an older
    order; items of newer orders are all added."""
    target = x.table("orders").where(F.col("o_orderdate") < CUT_NEW).select(
        "o_orderkey", F.lit(0.0).alias("quantity"), F.lit(None).cast("int").alias("line")
    )
    source = x.table("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").alias("line"),
        "l_shipdate",
    )
    return merge.upsert(
        target, source, ["o_orderkey"], ["quantity", "line"], prefer=[F.col("l_shipdate")]
    )


@query
def insert_missing(x: Inputs) -> DataFrame:
    """Order months added to a table of the earlier ones."""
    months = x.table("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
    known = months.where(F.col("year_month") < "1998-01").distinct()
    return merge.insert_missing(known, months, ["year_month"])


# Data checks.


def _dirty_lines(x: Inputs) -> DataFrame:
    return x.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_partkey") % 13 != 0, F.col("l_partkey")).alias("l_partkey"),
        (F.col("l_quantity") - 5).alias("l_quantity"),
    )


@query
def dq_not_null(x: Inputs) -> DataFrame:
    return quality.run_checks(
        _dirty_lines(x), [quality.NotNull("l_orderkey"), quality.NotNull("l_partkey")]
    )


@query
def dq_range(x: Inputs) -> DataFrame:
    return quality.run_checks(
        _dirty_lines(x),
        [quality.Between("l_quantity", low=0), quality.Between("l_partkey", low=1, high=500)],
    )


@query
def dq_unique(x: Inputs) -> DataFrame:
    return quality.run_checks(
        _dirty_lines(x),
        [
            quality.UniqueTogether(("l_orderkey", "l_linenumber")),
            quality.UniqueTogether(("l_partkey", "l_quantity")),
        ],
    )


@query
def dq_unique_wide(x: Inputs) -> DataFrame:
    """Keys that hold whole texts, and a key of all columns of the line items' part."""
    texts = quality.run_checks(
        x.table("documents"),
        [
            quality.UniqueTogether(("doc_id", "text"), wide=True),
            quality.UniqueTogether(("source", "text"), wide=True),
            quality.UniqueTogether(("text",), wide=True),
        ],
    )
    lines = quality.run_checks(_dirty_lines(x), [quality.UniqueTogether(("l_partkey", "l_quantity"), wide=True)])
    return texts.withColumn("table", F.lit("documents")).unionByName(lines.withColumn("table", F.lit("lineitem")))


@query
def dq_schema(x: Inputs) -> DataFrame:
    """Column order and types of the dirty lines, one expectation of each kind wrong."""
    return quality.run_checks(
        _dirty_lines(x),
        [
            quality.ColumnOrder(("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")),
            quality.ColumnOrder(("l_linenumber", "l_orderkey", "l_partkey", "l_quantity")),
            quality.ColumnType("l_quantity", "double"),
            quality.ColumnType("l_partkey", "string"),
        ],
    )


@query
def dq_summary(x: Inputs) -> DataFrame:
    checks = [
        quality.NotNull("l_orderkey"),
        quality.NotNull("l_partkey"),
        quality.Between("l_quantity", low=0),
        quality.UniqueTogether(("l_orderkey", "l_linenumber")),
    ]
    results = quality.run_checks(_dirty_lines(x), checks)
    return quality.suite_message(results, "lineitem.parquet")


@query
def dq_log_twice(x: Inputs) -> DataFrame:
    """The log of two runs over two tables, each run repeated after it had died half-way or at its end."""
    log = f"default.log_{materialise_tag()}"
    ddl = "severity string, message string"
    ledger = RunLedger(f"{log}_ledger", staging_root(x.spark))
    checks = [
        quality.NotNull("l_orderkey"),
        quality.NotNull("l_partkey"),
        quality.Between("l_quantity", low=0),
        quality.UniqueTogether(("l_orderkey", "l_linenumber")),
    ]
    lines = materialise(quality.suite_message(quality.run_checks(_dirty_lines(x), checks), "lineitem.parquet"))
    whole = quality.run_checks(x.table("orders"), [quality.NotNull("o_orderkey"), quality.UniqueTogether(("o_orderkey",))])
    orders = materialise(quality.suite_message(whole, "orders.parquet"))
    batches = [lines, orders]
    for run, order in (("first", [0, 1, 0, 1]), ("second", [0, 0, 1])):
        for batch in order:
            ledger.append_once(batches[batch], log, ddl, run, batch)
    return x.spark.table(log)


# Sources and cleaning.


@query
def json_array_scan(x: Inputs) -> DataFrame:
    """Documents landed as JSON arrays, texts and nested parts included, and read back by blocks."""
    nested = x.table("documents").select(
        "doc_id", "text", F.struct("lang").alias("place"), F.array(F.struct("source", "n_chars")).alias("parts")
    )
    path = landing.land_arrays(nested, f"{staging_root(x.spark)}/arrays-{materialise_tag()}")
    schema = "doc_id bigint, text string, place struct<lang string>, parts array<struct<source string, n_chars bigint>>"
    read = landing.read_json_array(x.spark, path, schema)
    part = F.get("parts", F.lit(0))
    return read.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.col("place.lang").alias("lang"),
        part["source"].alias("source"), part["n_chars"].alias("n_chars"),
    )


@query
def latest_year_pruned(x: Inputs) -> DataFrame:
    """Quantities per supplier of the latest year with known prices and the year before it, from a
    fact laid out by year."""
    year = F.year("l_shipdate")
    fact = x.table("lineitem").select(
        "l_suppkey", "l_quantity", year.alias("year"), F.when(year < 1998, F.col("l_extendedprice")).alias("price")
    )
    path = f"{staging_root(x.spark)}/fact-{materialise_tag()}"
    tables.write_by(fact, path, "year", "price")
    rows = tables.latest_of(x.spark, path, "year", back=1)
    return tidy(rows.groupBy("l_suppkey", "year").agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("n")))


@query
def json_extract(x: Inputs) -> DataFrame:
    props = F.from_json("props", "k int")
    return x.table("events").select("event_id", props["k"].alias("k"))


@query
def nested_json_scan(x: Inputs) -> DataFrame:
    """Customers landed as nested JSON, read back with a schema and flattened."""
    c, n = x.table("customer"), x.table("nation")
    nested = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.struct(F.col("n_name").alias("value")).alias("country"),
        F.col("c_mktsegment").alias("countryiso3code"),
        F.col("c_custkey").cast("string").alias("date"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).alias("value"),
    )
    root = f"{staging_root(x.spark)}/landed-{materialise_tag()}"
    path = landing.land(nested, root, "population", AS_OF, "json")
    raw = landing.read_json(x.spark, path, cleaning.RAW_INDICATOR, array=False)
    return cleaning.clean_indicator(raw, "population")


@query
def csv_scan(x: Inputs) -> DataFrame:
    """Suppliers landed as CSV, read back as text and typed."""
    s = x.table("supplier").join(x.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    extract = cleaning.YEARLY["production"]
    wide = s.select(
        F.col("s_name").alias("entity"),
        F.col("n_name").alias("code"),
        F.col("s_suppkey").alias("year"),
        F.col("s_acctbal").alias(next(iter(extract.renames))),
    )
    root = f"{staging_root(x.spark)}/landed-{materialise_tag()}"
    path = landing.land(wide, root, extract.landed, AS_OF, "csv")
    raw = landing.read_csv(x.spark, path, cleaning.expected_columns("production"))
    return conform(cleaning.clean_yearly(raw, extract), SILVER["production"])


def materialise_tag() -> str:
    import uuid

    return uuid.uuid4().hex


@query
def payload_unwrap(x: Inputs) -> DataFrame:
    """Each event as a paged document; some hold an error message and no rows."""
    documents = x.table("events").select(
        "event_id",
        F.when(
            F.col("event_type") == "error",
            F.lit('[{"message":"none"}]'),
        )
        .otherwise(
            F.concat(
                F.lit('[{"page":1},['),
                "props",
                F.lit(',{"k":'),
                F.col("user_id").cast("string"),
                F.lit("}]]"),
            )
        )
        .alias("payload"),
    )
    return landing.unwrap_payload(documents, "payload", {"k": "$.k bigint"})


@query
def latest_snapshot(x: Inputs) -> DataFrame:
    dated = x.table("events").select(
        "event_id", "user_id", F.to_date("ts").alias("ingestion_date")
    )
    return landing.latest_snapshot(dated)


@query
def alias_to_code(x: Inputs) -> DataFrame:
    """Customers' nation names, oddly written, matched to codes; one is unknown."""
    aliases = x.table("nation").where(F.col("n_nationkey") != 7).select(
        F.col("n_name").alias("alias"), F.concat(F.lit("C"), "n_nationkey").alias("iso3")
    )
    named = x.table("customer").join(
        x.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        "c_custkey",
        F.concat(F.lit(" "), F.initcap("n_name"), F.lit(" ")).alias("country"),
    )
    coded = lookup.names_to_codes(named, aliases, {"country": "iso3"})
    return coded.select("c_custkey", "iso3")


def _misspelled(x: Inputs) -> DataFrame:
    """Customers' nation names as they are, with one letter too few, wrong or too many, or with two."""
    key = F.col("c_custkey")
    at = (key % 5 + 2).cast("int")
    name = F.col("n_name")
    head, tail = F.left(name, at), F.substring(name, at + 1, F.length(name))
    less = F.concat(head, F.substring(name, at + 2, F.length(name)))
    other = F.concat(head, F.lit("X"), F.substring(name, at + 2, F.length(name)))
    more = F.concat(head, (key % 10).cast("string"), tail)
    odd = F.concat(F.lit("q"), head, F.lit("z"), tail)
    return (
        x.table("customer")
        .join(x.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(key % 7 == 0, name).when(key % 7 < 3, less).when(key % 7 == 3, other)
            .when(key % 7 < 6, F.lower(more)).otherwise(odd).alias("country")
        )
    )


def _nation_aliases(x: Inputs) -> DataFrame:
    """Nation names and codes; two nations share a code, and one name stands for two."""
    n = x.table("nation")
    code = F.concat(F.lit("C"), (F.col("n_nationkey") - F.when(F.col("n_nationkey") == 12, 11).otherwise(0)).cast("string"))
    twice = n.where("n_nationkey = 20").select(F.col("n_name").alias("alias"), F.lit("D20").alias("iso3"))
    return n.select(F.col("n_name").alias("alias"), code.alias("iso3")).unionByName(twice)


@query
def near_names(x: Inputs) -> DataFrame:
    return lookup.near_names(_misspelled(x), _nation_aliases(x), "country")


@query
def near_names_two_edits(x: Inputs) -> DataFrame:
    return lookup.near_names(_misspelled(x), _nation_aliases(x), "country", edits=2)


@query
def unknown_names(x: Inputs) -> DataFrame:
    aliases = x.table("nation").where(F.col("n_regionkey") < 4).select(
        F.col("n_name").alias("alias"), F.col("n_name").alias("iso3")
    )
    named = x.table("supplier").join(
        x.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("n_name").alias("country"))
    coded = lookup.names_to_codes(named, aliases, {"country": "iso3"})
    return lookup.unmatched_names(coded, {"country": "iso3"})


@query
def sentinel_to_null(x: Inputs) -> DataFrame:
    return cleaning.clean_distance(x.raw_distance)


@query
def text_to_number(x: Inputs) -> DataFrame:
    """Prices written with a symbol or not at all, back to numbers."""
    texts = x.table("part").select(
        "p_partkey",
        F.when(F.col("p_size") % 9 == 0, "n/a")
        .otherwise(F.concat(F.lit("€"), F.col("p_retailprice").cast(MONEY).cast("string")))
        .alias("price"),
    )
    bare = numbers.strip_symbol("price")
    return texts.select(
        "p_partkey",
        numbers.to_double(bare).alias("price"),
        numbers.to_whole(bare).alias("whole_price"),
    )


@query
def entity_year_key(x: Inputs) -> DataFrame:
    """Keys joined from their parts, a missing part left out."""
    return x.table("orders").select(
        "o_orderkey",
        keys.joined_key(
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.year("o_orderdate")
        ).alias("key"),
    )


@query
def state_month_keys(x: Inputs) -> DataFrame:
    """Composite keys of customer segment and month, and their parts."""
    built = x.table("orders").join(
        x.table("customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        "o_orderkey",
        keys.state_month_key(
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")),
            dates.named_month_text(F.date_format("o_orderdate", "MMMM"), F.year("o_orderdate")),
        ).alias("key"),
    )
    return built.select(
        "o_orderkey",
        "key",
        keys.state_of_key("key").alias("state"),
        keys.month_of_key("key").alias("year_month"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: q(Inputs(spark, sf_dir))

    return {name: bind(q) for name, q in REGISTRY.items()}
