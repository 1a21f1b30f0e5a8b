"""The trade model: incrementally filled facts, their bridge and the date table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import dates, keys
from tradewind.operators.bucketing import biggest_or_other
from tradewind.operators.staging import materialise
from tradewind.schemas import TRADE, layout
from tradewind.sources import tables
from tradewind.sources.snapshots import NO_VALUE, Snapshot, SnapshotTable

TRADE_KEYS = ["trade_key", "partner", "flow", "product_group"]
TRADE_VALUES = [
    "product_weight_in_tonnes",
    "carcase_weight_in_tonnes",
    "value_in_thousand_euro",
    "last_month",
]
PRICE_KEYS = ["prices_key", "pig_class", "week_number"]
PRICE_VALUES = ["price", "unit"]
PRODUCTION_KEYS = ["prod_key"]
PRODUCTION_VALUES = ["heads", "kg_per_head", "tonnes", "country_group"]
# Fixed value: the pig class whose price stands for a state.
LEADING_CLASS = "Average S + E"


def trade_rows(trade: DataFrame) -> DataFrame:
    """Summed trade with each partner's last month in the latest year.

    Partners without trade in the latest year drop out. The large table is read
    once: it is summed first, and the partners' last months come from the sums.
    """
    sums = materialise(
        trade.groupBy(
            "member_state", "partner", "flow", "marketing_year", "month_order", "product_group"
        ).agg(
            F.sum("product_weight_in_tonnes").alias("product_weight_in_tonnes"),
            F.sum("carcase_weight_in_tonnes").alias("carcase_weight_in_tonnes"),
            F.sum("value_in_thousand_euro").alias("value_in_thousand_euro"),
        )
    )
    latest_year = sums.agg(F.max("marketing_year").alias("y")).scalar()
    last_months = materialise(
        sums.where(F.col("marketing_year") == latest_year)
        .groupBy("partner")
        .agg(F.max("month_order").alias("last_month"))
    )
    # Unreadable years or months give several months one key; they become one row.
    month = dates.month_text("marketing_year", "month_order")
    keyed = sums.withColumn("trade_key", keys.state_month_key("member_state", month))
    amounts = ["product_weight_in_tonnes", "carcase_weight_in_tonnes", "value_in_thousand_euro"]
    rows = keyed.groupBy(*TRADE_KEYS).agg(*[F.sum(c).alias(c) for c in amounts])
    return rows.join(last_months, "partner").select(
        "partner", "flow", "product_group", *amounts, "trade_key", "last_month"
    )


MONTH_SUMS = (
    "part_month string, trade_key string, partner string, flow string, product_group string, "
    "marketing_year int, month_order int, product_weight_in_tonnes double, "
    "carcase_weight_in_tonnes double, value_in_thousand_euro double"
)
AMOUNTS = ["product_weight_in_tonnes", "carcase_weight_in_tonnes", "value_in_thousand_euro"]


def trade_sums(spark: SparkSession, root: str) -> SnapshotTable:
    """The maintained sums behind the trade fact, one part per month."""
    return SnapshotTable(spark, root, MONTH_SUMS, "part_month")


def _month_sums(trade: DataFrame) -> DataFrame:
    month = dates.month_text("marketing_year", "month_order")
    return (
        trade.groupBy("member_state", "partner", "flow", "marketing_year", "month_order", "product_group")
        .agg(*[F.sum(c).cast("double").alias(c) for c in AMOUNTS])
        .withColumn("part_month", month)
        .withColumn("trade_key", keys.state_month_key("member_state", month))
        .groupBy("part_month", *TRADE_KEYS, "marketing_year", "month_order")
        .agg(*[F.sum(c).alias(c) for c in AMOUNTS])
    )


def touched_months(
    trade: DataFrame, since: str | None
) -> tuple[set[tuple[int | None, int | None]], str | None]:
    """Marketing years and months of the lines created on or after ``since``, and the newest day.

    One pair per month, so few however many lines there are. The stamp is a filter of the scan;
    lines without one always count.
    """
    if since is not None:
        trade = trade.where((F.col("created") >= F.lit(since).cast("date")) | F.col("created").isNull())
    found = trade.groupBy("marketing_year", "month_order").agg(F.max("created").alias("day")).collect()
    days = [r.day.isoformat() for r in found if r.day is not None]
    return {(r.marketing_year, r.month_order) for r in found}, max(days, default=since)


def _of_months(trade: DataFrame, months: set[tuple[int | None, int | None]]) -> DataFrame:
    """The lines of some months. Years and months are literals: partitions by year are pruned."""
    by_year: dict[int | None, list[int | None]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)

    def any_of(c: str, values: list[int | None]) -> Column:
        known = [v for v in values if v is not None]
        found = F.col(c).isin(known) if known else F.lit(False)
        return found | F.col(c).isNull() if None in values else found

    wanted = any_of("marketing_year", list(by_year))
    each = [any_of("marketing_year", [y]) & any_of("month_order", m) for y, m in by_year.items()]
    return trade.where(wanted & reduce(Column.__or__, each))


def refresh_trade(trade: DataFrame, sums: SnapshotTable, rebuild: bool = False) -> Snapshot:
    """Bring the maintained sums up to date with the cleaned trade lines.

    Only months that got lines since the last run are read and summed again, then put live by
    one switch together with the newest ``created`` day they reach to. Lines of that day may still
    come after it, so the day itself counts again; a repeated run gives the same sums. Stamps
    must not go back: after lines with older ones, or lines taken out, ask for a ``rebuild`` of all months.
    """
    base = sums.live()
    months, day = touched_months(trade, None if rebuild else base.mark)
    labels = {_label(*m) for m in months}
    if rebuild:
        labels |= set(base.folders)
    if not labels and base.number:
        return base
    if NO_VALUE in labels:
        # Months that no calendar has share one part, which is renewed as a whole.
        strange, _ = touched_months(trade.where(dates.month_text("marketing_year", "month_order").isNull()), None)
        months = months | strange
    lines = _of_months(trade, months) if months else trade.limit(0)
    return sums.renew(_month_sums(lines), labels, base, day)


def _label(year: int | None, month: int | None) -> str:
    if year is None or month is None or not (1 <= month <= 12 and 0 < year <= 9999):
        return NO_VALUE
    return f"{year:04d}-{month:02d}"


def trade_fact(sums: SnapshotTable, snapshot: Snapshot | None = None) -> DataFrame:
    """The trade fact of a snapshot: as ``trade_rows`` over all lines, without reading any.

    Partners' last months come from the parts of the latest year alone.
    """
    held = snapshot or sums.live()
    years = {p[:4] for p in held.folders if p != NO_VALUE}
    recent = {p for p in held.folders if p == NO_VALUE or p[:4] == max(years)}
    late = sums.read(held, recent)
    latest_year = late.agg(F.max("marketing_year").alias("y")).scalar()
    last_months = (
        late.where(F.col("marketing_year") == latest_year)
        .groupBy("partner")
        .agg(F.max("month_order").alias("last_month"))
    )
    columns = [*TRADE_KEYS, *AMOUNTS]
    whole = sums.read(held, set(held.folders) - {NO_VALUE}).select(*columns)
    # Months that no calendar has share a key; they become one row.
    rest = sums.read(held, {NO_VALUE}).groupBy(*TRADE_KEYS).agg(*[F.sum(c).alias(c) for c in AMOUNTS])
    return whole.unionByName(rest.select(*columns)).join(last_months, "partner").select(
        "partner", "flow", "product_group", *AMOUNTS, "trade_key", "last_month"
    )


def publish_trade(sums: SnapshotTable, snapshot: Snapshot, view: str) -> None:
    """Make ``view`` show the trade fact of a snapshot: its text names the folders, so replacing it is
    one step of the catalog, and readers of the old text keep the old folders."""
    spark = sums.spark
    def rows(parts: list[str]) -> str:
        if not parts:
            empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in layout(MONTH_SUMS))
            return f"(SELECT {empty} WHERE false)"
        return f"parquet.`{sums.root}/{{{','.join(snapshot.folders[p] for p in sorted(parts))}}}`"

    known = [p for p in snapshot.folders if p != NO_VALUE]
    strange = [p for p in snapshot.folders if p == NO_VALUE]
    recent = strange + [p for p in known if p[:4] == max(known)[:4]]
    amounts = ", ".join(AMOUNTS)
    summed = ", ".join(f"sum({c}) AS {c}" for c in AMOUNTS)
    by = ", ".join(TRADE_KEYS)
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
        WITH late AS (SELECT * FROM {rows(recent)}),
        last_months AS (SELECT partner, max(month_order) AS last_month FROM late
          WHERE marketing_year = (SELECT max(marketing_year) FROM late) GROUP BY partner),
        sums AS (SELECT {by}, {amounts} FROM {rows(known)}
          UNION ALL SELECT {by}, {summed} FROM {rows(strange)} GROUP BY {by})
        SELECT partner, flow, product_group, {amounts}, trade_key, last_month
        FROM sums JOIN last_months USING (partner)"""
    )


def price_rows(prices: DataFrame, pig_class: str = LEADING_CLASS) -> DataFrame:
    return prices.where(F.col("pig_class") == pig_class).select(
        "pig_class",
        "price",
        "unit",
        "week_number",
        keys.state_month_key(
            "member_state_name", dates.month_text("year", "month_number")
        ).alias("prices_key"),
    )


def production_rows(
    production: DataFrame, as_of: dt.date | Column | None = None, keep: int = 7, years: int = 4
) -> DataFrame:
    """Monthly production in kilograms, small states grouped as 'Other'.

    States are ranked by their production since ``years`` years before ``as_of``;
    a state without rows there drops out.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of) if as_of else F.current_date()
    groups = biggest_or_other(
        production,
        "member_state_name",
        "tonnes",
        keep,
        recent=F.col("year") >= F.year(day) - years,
    )
    month = dates.named_month_text("month", "year")
    return production.join(groups, "member_state_name").select(
        "heads",
        "kg_per_head",
        (F.col("tonnes") * 1000).alias("tonnes"),
        keys.state_month_key("member_state_name", month).alias("prod_key"),
        "country_group",
    )


def bridge_rows(trade: DataFrame, prices: DataFrame, production: DataFrame) -> DataFrame:
    """Every state-month any fact mentions.

    Each fact's keys are made distinct before the union, so only keys are shuffled.
    """
    parts = [
        trade.select(F.col("trade_key").alias("bridge_key")).distinct(),
        prices.select(F.col("prices_key").alias("bridge_key")).distinct(),
        production.select(F.col("prod_key").alias("bridge_key")).distinct(),
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .distinct()
        .select(
            "bridge_key",
            keys.state_of_key("bridge_key").alias("member_state"),
            keys.month_of_key("bridge_key").alias("year_month"),
        )
    )


def date_rows(bridge: DataFrame) -> DataFrame:
    """Calendar attributes of the bridge's months."""
    day = dates.month_start("year_month")
    return (
        bridge.select("year_month")
        .distinct()
        .select(
            "year_month",
            F.year(day).alias("year"),
            F.month(day).alias("month_number"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "MMM").alias("month_short_name"),
            F.replace("year_month", F.lit("-"), F.lit("")).try_cast("int").alias("year_month_int"),
        )
    )


def run_trade(
    spark: SparkSession, silver: str, database: str, as_of: dt.date | None = None
) -> None:
    """Refresh the trade model from the cleaned tables.

    The trade fact is a view of maintained monthly sums; the months with new lines are summed
    again. Facts with one source row per key, bridge and dates are the same after a repeat. Prices may
    hold several rows of one key: they are all inserted once, and a repeat sets them to the first.
    """

    def name(table: str) -> str:
        return f"{database}.{table}"

    folder = spark.catalog.getDatabase(database).locationUri
    sums = trade_sums(spark, f"{folder}/trade_sums")
    publish_trade(sums, refresh_trade(spark.table(f"{silver}.trade_silver"), sums), name("fact_trade"))
    tables.upsert_table(
        price_rows(spark.table(f"{silver}.prices_silver")),
        name("fact_prices"),
        TRADE["fact_prices"],
        PRICE_KEYS,
        PRICE_VALUES,
    )
    tables.upsert_table(
        production_rows(spark.table(f"{silver}.production_silver"), as_of),
        name("fact_production"),
        TRADE["fact_production"],
        PRODUCTION_KEYS,
        PRODUCTION_VALUES,
    )
    tables.merge_new_rows(
        bridge_rows(
            spark.table(name("fact_trade")),
            spark.table(name("fact_prices")),
            spark.table(name("fact_production")),
        ),
        name("bridge_member_date"),
        TRADE["bridge_member_date"],
        ["bridge_key"],
    )
    tables.merge_new_rows(
        date_rows(spark.table(name("bridge_member_date"))),
        name("dim_date"),
        TRADE["dim_date"],
        ["year_month"],
    )
