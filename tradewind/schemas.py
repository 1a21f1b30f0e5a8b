"""Table layouts and conformance to them.

Names and types are fixed values. Measures declared as 32-bit floats in the source
system are widened to doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.numbers import to_whole

# Cleaned tables.
SILVER = {
    "prices_silver": (
        "begin_date date, end_date date, member_state_code string, member_state_name string, "
        "pig_class string, price double, unit string, week_number int, year int, "
        "year_week string, month_number int, created date, modified date"
    ),
    "production_silver": (
        "heads double, kg_per_head double, member_state_code string, member_state_name string, "
        "month string, tonnes double, year int, created date, modified date"
    ),
    "trade_silver": (
        "flow string, marketing_year int, month string, month_order int, month_date string, "
        "member_state string, partner string, product_group string, product_code string, "
        "product_weight_in_tonnes double, carcase_weight_in_tonnes double, "
        "value_in_thousand_euro double, created date, modified date"
    ),
    "tariff": (
        "reporting_country string, reporting_country_iso3 string, partner_country string, "
        "partner_country_iso3 string, year int, revision string, product_code string, "
        "product_description string, no_of_tariff_lines int, tariff_regime string, "
        "tariff_average double, created date, modified date"
    ),
    "consumption": "entity string, code string, year int, consumption_tones int, key string",
    "production": "entity string, code string, year int, production_tonnes double, key string",
    "import": "entity string, code string, year int, import_tonnes double, key string",
    "domestic_supply": (
        "entity string, code string, year int, domestic_supply_tones int, key string"
    ),
    "gdp_growth": (
        "entity string, code string, year int, gdp_change double, gdp_change_forecast double, "
        "gdp_change_annotations string, gdp_change_forecast_annotations string, key string"
    ),
    "distance": "iso_o string, iso_d string, dist double",
    "population": "country string, iso3 string, year int, population bigint",
    "gdp_per_capita": "country string, iso3 string, year int, gdp_per_capita bigint",
}

# Star schema of the market model.
MARKET = {
    "country_ids": "iso3 string, country_id int",
    "dim_calendar": "year bigint",
    "dim_partner": "country_id int, iso3 string, name string, faostat_fallback int",
    "dim_ue_country": "country_id int, iso3 string, name string",
    "fact_production": "country_id int, year int, production_tonnes double",
    "fact_import": "country_id int, year int, import_tonnes double",
    "fact_consumption": "country_id int, year int, consumption_tones int",
    "fact_pork_market": (
        "country_id int, year int, production_tonnes double, import_tonnes double, "
        "consumption_tones int, import_gap double, import_gap_normalized double, "
        "import_size_normalized double"
    ),
    "fact_pork_market_growth": (
        "country_id int, gdp_forecast_growth_avg double, n_years bigint, "
        "gdp_growth_forecast_normalized double, import_CAGR double, first_year int, "
        "last_year int, max_year int, n_periods_non_null bigint, import_CAGR_normalized double"
    ),
    "fact_trade_barriers": (
        "country_id int, tariff_avg double, tariff_avg_normalized double, dist double, "
        "dist_normalized double"
    ),
    "fact_gdp_growth_forecast": "country_id int, year int, gdp_change_forecast double",
    "fact_distance": "country_id_o int, country_id_d int, dist double",
    "fact_tariff": (
        "reporting_country_id int, partner_country_id int, year int, tariff_average double"
    ),
}

# Incrementally filled star schema of the trade model.
TRADE = {
    "fact_trade": (
        "partner string, flow string, product_group string, product_weight_in_tonnes double, "
        "carcase_weight_in_tonnes double, value_in_thousand_euro double, trade_key string, "
        "last_month int"
    ),
    "fact_prices": (
        "pig_class string, price double, unit string, week_number int, prices_key string"
    ),
    "fact_production": (
        "heads double, kg_per_head double, tonnes double, prod_key string, country_group string"
    ),
    "bridge_member_date": "bridge_key string, member_state string, year_month string",
    "dim_date": (
        "year_month string, year int, month_number int, month_name string, "
        "month_short_name string, year_month_int int"
    ),
}

# Declared text lengths, checked on demand only.
TEXT_LIMITS = {
    "fact_trade": {"partner": 255, "flow": 6, "product_group": 255, "trade_key": 255},
    "fact_prices": {"pig_class": 30, "unit": 15, "prices_key": 255},
    "fact_production": {"prod_key": 255, "country_group": 30},
    "bridge_member_date": {"bridge_key": 255, "member_state": 30, "year_month": 10},
    "dim_date": {"year_month": 10, "month_name": 15, "month_short_name": 3},
}


def layout(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _conformed(name: str, have: T.DataType, want: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if have == want:
        return c
    if isinstance(want, (T.IntegerType, T.LongType)) and isinstance(have, T.StringType):
        return to_whole(c, want.simpleString())
    if isinstance(want, T.DateType) and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(want, T.StringType):
        return c.cast(want)
    return c.try_cast(want)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of the layout in its order and types; unreadable values are NULL.

    A missing column is an error, an extra one is dropped.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    fields = layout(ddl).fields
    missing = [f.name for f in fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(
        *[_conformed(f.name, have[f.name], f.dataType).alias(f.name) for f in fields]
    )


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Count, per limited column, the texts over their declared length."""
    counts = df.agg(
        *[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()]
    )
    return counts.unpivot([], list(limits), "column", "n_too_long")
