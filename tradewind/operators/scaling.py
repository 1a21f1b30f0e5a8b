"""Min-max scaling and winsorising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import finite, unit_scale
from tradewind.operators.ordering import exact_quantiles, sketch_quantiles
from tradewind.operators.staging import materialise


def _targets(values: str | dict[str, str]) -> dict[str, str]:
    return {values: f"{values}_normalized"} if isinstance(values, str) else values


def minmax_by(df: DataFrame, values: str | dict[str, str], by: str) -> DataFrame:
    """Scale columns to [0, 1] inside each group of ``by``.

    ``values`` is a column name or a mapping from column to result name. The
    extremes come from one grouped aggregate with map-side combine, so a group
    holding most rows is never gathered in one task, and are joined back. NULL
    and NaN give NULL, as does a constant group. ``df`` is read twice: pass a table.
    """
    targets = _targets(values)
    bounds = []
    for i, c in enumerate(targets):
        bounds += [F.min(finite(c)).alias(f"__lo{i}"), F.max(finite(c)).alias(f"__hi{i}")]
    stats = materialise(df.groupBy(F.col(by).alias("__by")).agg(*bounds))
    joined = df.join(stats, F.col(by).eqNullSafe(F.col("__by")))
    scaled = [
        unit_scale(finite(c), F.col(f"__lo{i}"), F.col(f"__hi{i}")).alias(name)
        for i, (c, name) in enumerate(targets.items())
    ]
    return joined.select(*[F.col(c) for c in df.columns], *scaled)


def minmax_overall(df: DataFrame, values: str | dict[str, str]) -> DataFrame:
    """Scale columns to [0, 1] over the whole frame.

    All extremes come from one scalar subquery: one extra pass, and nothing goes
    through the driver.
    """
    targets = _targets(values)
    bounds = []
    for i, c in enumerate(targets):
        bounds += [F.min(finite(c)).alias(f"low{i}"), F.max(finite(c)).alias(f"high{i}")]
    extremes = df.agg(F.struct(*bounds).alias("extremes")).scalar()
    scaled = [
        unit_scale(finite(c), extremes[f"low{i}"], extremes[f"high{i}"]).alias(name)
        for i, (c, name) in enumerate(targets.items())
    ]
    return df.select("*", *scaled)


def _limits(
    df: DataFrame, value: str, lower: float | None, upper: float | None, accuracy: int | None
) -> Column:
    """Struct ``(low, high)`` between which values stay: quantiles, or the extremes on
    a side without one. Both ends are values of the data."""
    probs = {"low": lower or 0.0, "high": 1.0 if upper is None else upper}
    if accuracy is None:
        ends = exact_quantiles(df, value, probs)
    else:
        ends = sketch_quantiles(df, value, probs, accuracy)
    return ends.select(F.struct("low", "high").alias("limits")).scalar()


def _clipped(value: str, limits: Column) -> Column:
    inside = F.least(F.greatest(F.col(value), limits["low"]), limits["high"])
    return F.when(F.col(value).isNotNull(), inside)


def winsorise(
    df: DataFrame,
    value: str,
    into: str,
    lower: float | None = None,
    upper: float | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Pull values beyond the given quantiles back to them; NULL stays NULL.

    Exact by default; ``accuracy`` switches to a bounded sketch.
    """
    return df.withColumn(into, _clipped(value, _limits(df, value, lower, upper, accuracy)))


def winsorised_minmax(
    df: DataFrame,
    value: str,
    into: str,
    lower: float | None = None,
    upper: float | None = None,
    accuracy: int | None = None,
    given: DataFrame | None = None,
) -> DataFrame:
    """Winsorise, then scale to [0, 1]; the raw value is kept.

    The limits are themselves the extremes of the winsorised values, so scaling needs
    no further pass. ``given``, one row (low, high), states them, such as limits from stored
    sketches; ``df`` is then read once.
    """
    if given is None:
        limits = _limits(df, value, lower, upper, accuracy)
    else:
        limits = given.select(F.struct("low", "high").alias("limits")).scalar()
    return df.withColumn(
        into, unit_scale(_clipped(value, limits), limits["low"], limits["high"])
    )
