"""Aggregate expressions and default column summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns whose default summary is a sum; every other column has none.
SUMMED_COLUMNS = (
    "production_tonnes",
    "import_tonnes",
    "consumption_tones",
    "import_gap",
    "import_gap_normalized",
    "import_size_normalized",
    "gdp_forecast_growth_avg",
    "n_years",
    "gdp_growth_forecast_normalized",
    "import_CAGR",
    "n_periods_non_null",
    "import_CAGR_normalized",
    "tariff_avg",
    "tariff_avg_normalized",
    "dist",
    "dist_normalized",
    "faostat_fallback",
)


def selected_value(c: str) -> Column:
    """The value of ``c`` when the group holds exactly one, else NULL."""
    single = (F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c))
    return F.when(single, F.max(c))


def summarize(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Group by ``by`` and apply each column's default summary."""
    wanted = columns or [c for c in df.columns if c in SUMMED_COLUMNS and c not in by]
    unknown = [c for c in wanted if c not in SUMMED_COLUMNS]
    if unknown:
        raise ValueError(f"no default summary for {unknown}")
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in wanted])
