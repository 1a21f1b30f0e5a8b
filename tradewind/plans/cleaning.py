"""Landed extracts to cleaned tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import dates, keys, numbers
from tradewind.operators.lookup import names_to_codes
from tradewind.operators.quality import (
    Between,
    Check,
    NotNull,
    UniqueTogether,
    ValidationStopped,
    columns_match,
    error_row,
    log_rows,
    run_checks,
    suite_message,
)
from tradewind.operators.staging import materialise
from tradewind.schemas import SILVER, conform
from tradewind.sources import landing, tables
from tradewind.sources.ledger import RunLedger


@dataclass(frozen=True)
class YearlyExtract:
    """A country-by-year extract: where it lands, and its value columns."""

    landed: str
    renames: dict[str, str]
    types: dict[str, str]


# Column names of the published extracts.
YEARLY = {
    "consumption": YearlyExtract(
        "pork_consumption",
        {"meat__pig__00002733__food__005142__tonnes": "consumption_tones"},
        {"consumption_tones": "int"},
    ),
    "production": YearlyExtract(
        "pork_production",
        {"meat__pig__00001035__production__005510__tonnes": "production_tonnes"},
        {"production_tonnes": "double"},
    ),
    "import": YearlyExtract(
        "pork_import",
        {"meat__pig__00002733__imports__005611__tonnes": "import_tonnes"},
        {"import_tonnes": "double"},
    ),
    "domestic_supply": YearlyExtract(
        "pork_domestic_supply",
        {"meat__pig__00002733__domestic_supply__005301__tonnes": "domestic_supply_tones"},
        {"domestic_supply_tones": "int"},
    ),
    "gdp_growth": YearlyExtract(
        "gdp_growth",
        {
            "gross_domestic_product__gdp__constant_prices__percent_change_observation": "gdp_change",
            "gross_domestic_product__gdp__constant_prices__percent_change_forecast__projected": "gdp_change_forecast",
            "gross_domestic_product__gdp__constant_prices__percent_change_observation__annotations": "gdp_change_annotations",
            "gross_domestic_product__gdp__constant_prices__percent_change_forecast__annotations": "gdp_change_forecast_annotations",
        },
        {"gdp_change": "double", "gdp_change_forecast": "double"},
    ),
}
PRICE_NAMES = {
    "beginDate": "begin_date",
    "endDate": "end_date",
    "memberStateCode": "member_state_code",
    "memberStateName": "member_state_name",
    "pigClass": "pig_class",
}
PRODUCTION_NAMES = {
    "kgPerHead": "kg_per_head",
    "memberStateCode": "member_state_code",
    "memberStateName": "member_state_name",
}
TRADE_NAMES = {
    "Flow": "flow",
    "Marketing Year": "marketing_year",
    "Month": "month",
    "Month Order in MY": "month_order",
    "Month Date": "month_date",
    "Member State": "member_state",
    "Partner": "partner",
    "Product Group": "product_group",
    "Product Code (CN)": "product_code",
    "Product Weight in tonnes": "product_weight_in_tonnes",
    "Carcase Weight in tonnes": "carcase_weight_in_tonnes",
    "Value in thousand euro": "value_in_thousand_euro",
}
TARIFF_NAMES = {
    "ReportingCountry": "reporting_country",
    "PartnerCountry": "partner_country",
    "Year": "year",
    "Revision": "revision",
    "ProductCode": "product_code",
    "ProductDescription": "product_description",
    "NoOfTariffLines": "no_of_tariff_lines",
    "TariffRegime": "tariff_regime",
    "AVE": "tariff_average",
}
RAW_PRICES = (
    "memberStateCode string, memberStateName string, beginDate string, endDate string, "
    "price string, unit string, weekNumber bigint, pigClass string"
)
RAW_PRODUCTION = (
    "memberStateCode string, memberStateName string, month string, year int, heads double, "
    "kgPerHead double, tonnes double"
)
RAW_INDICATOR = (
    "country struct<value: string>, countryiso3code string, date string, value string"
)
# Keys by which a new extract is compared with the table.
MERGE_KEYS = {
    "prices_silver": ["member_state_code", "begin_date", "pig_class"],
    "production_silver": ["member_state_code", "month", "year"],
    "trade_silver": ["flow", "month_date", "member_state", "partner", "product_code"],
    "tariff": ["reporting_country", "partner_country", "year", "product_code"],
}
# The merge key whose range limits how much of the table is read.
RANGE_KEYS = {
    "prices_silver": "begin_date",
    "production_silver": "year",
    "trade_silver": "month_date",
    "tariff": "year",
}
PARTITIONS = {
    "prices_silver": ["year"],
    "production_silver": ["year"],
    "trade_silver": ["marketing_year"],
    "tariff": ["year"],
}


def _stamped(df: DataFrame, run_date: dt.date | None) -> DataFrame:
    day = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return df.withColumns({"created": day, "modified": day})


def clean_prices(raw: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Weekly prices: number and dates parsed, month and ISO week added.

    Rows without a readable period are dropped. All row-local, no shuffle.
    """
    parsed = raw.withColumnsRenamed(PRICE_NAMES).withColumns(
        {
            "price": numbers.to_double(numbers.strip_symbol("price")),
            "begin_date": dates.parse_day("begin_date"),
            "end_date": dates.parse_day("end_date"),
        }
    )
    placed = parsed.where(F.col("begin_date").isNotNull() & F.col("end_date").isNotNull())
    placed = placed.withColumn("__month", dates.majority_month("begin_date", "end_date"))
    timed = placed.withColumns(
        {
            "year": F.col("__month.year"),
            "month_number": F.col("__month.month_number"),
            "week_number": dates.iso_week("begin_date"),
        }
    ).withColumn("year_week", dates.year_week("year", "week_number"))
    return conform(_stamped(timed, run_date), SILVER["prices_silver"])


def clean_production(raw: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    named = raw.withColumnsRenamed(PRODUCTION_NAMES)
    return conform(_stamped(named, run_date), SILVER["production_silver"])


def clean_trade(
    exports: DataFrame, imports: DataFrame, run_date: dt.date | None = None
) -> DataFrame:
    """Export and import extracts as one table; all input columns are text."""
    both = exports.withColumnsRenamed(TRADE_NAMES).unionByName(
        imports.withColumnsRenamed(TRADE_NAMES)
    )
    return conform(_stamped(both, run_date), SILVER["trade_silver"])


def clean_tariff(
    raw: DataFrame, aliases: DataFrame, run_date: dt.date | None = None
) -> DataFrame:
    """Tariff lines with country codes looked up by name."""
    coded = names_to_codes(
        raw.withColumnsRenamed(TARIFF_NAMES),
        aliases,
        {
            "reporting_country": "reporting_country_iso3",
            "partner_country": "partner_country_iso3",
        },
    )
    return conform(_stamped(coded, run_date), SILVER["tariff"])


def clean_yearly(raw: DataFrame, extract: YearlyExtract) -> DataFrame:
    """Country-by-year values with typed columns and an ``entity_year`` key."""
    named = raw.withColumnsRenamed(extract.renames)
    typed: dict[str, Column] = {"year": numbers.to_whole("year")}
    for c, kind in extract.types.items():
        typed[c] = numbers.to_double(c) if kind == "double" else numbers.to_whole(c, kind)
    return named.withColumns(typed).withColumn("key", keys.joined_key("entity", "year"))


def clean_distance(raw: DataFrame, sentinel: str = ".") -> DataFrame:
    """Distances; the sentinel in any text column means missing."""
    texts = [c for c, t in raw.dtypes if t == "string"]
    blanked = raw.withColumns({c: numbers.null_if_sentinel(c, sentinel) for c in texts})
    if "dist" not in blanked.columns:
        return blanked
    return blanked.withColumn("dist", numbers.to_double("dist"))


def clean_indicator(raw: DataFrame, into: str) -> DataFrame:
    """Nested country indicators, flattened: country, iso3, year, value."""
    return raw.select(
        F.col("country.value").alias("country"),
        F.col("countryiso3code").alias("iso3"),
        numbers.to_whole("date").alias("year"),
        numbers.to_whole("value", "bigint").alias(into),
    )


# Files checked before cleaning, with their expected columns.
CHECKED = ("production", "import", "consumption")
_LOG = "timestamp timestamp, severity string, message string, ingestion_date date"
# The batch number of the log rows of a run that was stopped.
STOPPED = -1


def expected_columns(dataset: str) -> list[str]:
    return ["entity", "code", "year", *YEARLY[dataset].renames]


def checks_for(dataset: str) -> list[Check]:
    checks: list[Check] = [NotNull("entity"), NotNull("year"), NotNull("code")]
    if dataset == "production":
        checks.append(Between(next(iter(YEARLY[dataset].renames)), low=0))
    return [*checks, UniqueTogether(("entity", "year"))]


def validate_landed(
    spark: SparkSession,
    root: str,
    day: dt.date,
    log_table: str = "validation_logs",
    ledger: RunLedger | None = None,
    run: str | None = None,
) -> DataFrame:
    """Check the yearly extracts of a day and log one message per file.

    Row rules are logged and the run goes on; wrong columns or an unreadable file
    are logged and stop it. Returns the logged messages of the row rules. With a ``ledger``, a ``run``
    (the day, if not given) logs its messages once, however often it is repeated; of the attempts that
    were stopped, the log holds the last, as batch ``STOPPED``.
    """
    run = run or str(day)
    messages: DataFrame | None = None

    def log(rows: DataFrame | None, stopped: bool) -> None:
        if ledger is None:
            if rows is not None:
                _log(rows, log_table)
        elif stopped:
            ledger.replace(rows, log_table, _LOG, run, STOPPED)
        else:
            ledger.append_once(rows, log_table, _LOG, run)

    def stop(text: str) -> None:
        error = error_row(spark.range(1), text, day)
        log(error if messages is None else log_rows(messages, day).unionByName(error), True)

    for dataset in CHECKED:
        path = landing.landing_path(root, YEARLY[dataset].landed, day)
        name = path.rsplit("/", 1)[-1]
        wanted = expected_columns(dataset)
        try:
            found = landing.read_csv_header(spark, path)
        except Exception as problem:
            stop(f"💥 Error processing {name}: {problem}")
            raise ValidationStopped(f"cannot read {name}") from problem
        if found != wanted:
            text = f"❌ Missing or incorrect columns in file {path}. Expected: {wanted}"
            stop(text)
            raise ValidationStopped(text)
        frame = landing.read_csv(spark, path, wanted)
        assert columns_match(frame, wanted)
        # A number that is no number counts as missing, as for the typed table.
        values = {c: numbers.to_double(c) for c in YEARLY[dataset].renames}
        one = materialise(
            suite_message(run_checks(frame.withColumns(values), checks_for(dataset)), name)
        )
        messages = one if messages is None else messages.unionByName(one)
    log(log_rows(messages, day), False)
    return messages


def _log(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").format("parquet").saveAsTable(table)


def run_cleaning(
    spark: SparkSession,
    root: str,
    database: str,
    day: dt.date | dict[str, dt.date] | None,
    aliases: DataFrame,
    distance_columns: list[str],
) -> None:
    """Clean every landed source into the tables of a database.

    ``day`` is the date of all files, or a date per source; sources without one, and all for None,
    are read at their newest. All files are looked up before the first table is touched, so a
    missing one stops the run and leaves nothing half done. Rows are stamped with the day, or with
    the newest of several. The distance table keeps all ``distance_columns``.
    """
    sources = ["ue_pork_prices", "ue_pork_production", "pigs_trade_export", "pigs_trade_import", "pork_tariff",
               *(extract.landed for extract in YEARLY.values()), "distance", "population", "gdp_per_capita"]
    paths, day = landing.landed_paths(spark, root, sources, day)

    def path(key: str) -> str:
        return paths[key]

    def merge(df: DataFrame, table: str) -> None:
        tables.merge_new_rows(
            df,
            f"{database}.{table}",
            SILVER[table],
            MERGE_KEYS[table],
            RANGE_KEYS.get(table),
            PARTITIONS[table],
        )

    merge(
        clean_prices(landing.read_json(spark, path("ue_pork_prices"), RAW_PRICES), day),
        "prices_silver",
    )
    merge(
        clean_production(
            landing.read_json(spark, path("ue_pork_production"), RAW_PRODUCTION), day
        ),
        "production_silver",
    )
    exports = landing.read_csv(spark, path("pigs_trade_export"), list(TRADE_NAMES))
    imports = landing.read_csv(spark, path("pigs_trade_import"), list(TRADE_NAMES))
    merge(clean_trade(exports, imports, day), "trade_silver")
    merge(
        clean_tariff(
            landing.read_csv(spark, path("pork_tariff"), list(TARIFF_NAMES)), aliases, day
        ),
        "tariff",
    )
    for table, extract in YEARLY.items():
        raw = landing.read_csv(
            spark, path(extract.landed), ["entity", "code", "year", *extract.renames]
        )
        tables.overwrite_table(clean_yearly(raw, extract), f"{database}.{table}", SILVER[table])
    raw = landing.read_csv(spark, path("distance"), distance_columns)
    distances = clean_distance(raw)
    ddl = ", ".join(f"`{c}` {kind}" for c, kind in distances.dtypes)
    tables.overwrite_table(distances, f"{database}.distance", ddl)
    for table in ("population", "gdp_per_capita"):
        raw = landing.read_json(spark, path(table), RAW_INDICATOR)
        tables.overwrite_table(clean_indicator(raw, table), f"{database}.{table}", SILVER[table])
