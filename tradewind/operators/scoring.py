"""Weights, score tree, indicator breakdown and explanatory texts.

Weights are columns of the frame being scored, so one job can score any number of
scenarios.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import blank_sum, blank_text, plain_number


@dataclass(frozen=True)
class Weights:
    """Shares of the left branch at each node of the score tree."""

    demand: float = 0.9
    trade: float = 0.7
    tariff: float = 0.5
    cagr: float = 0.5
    import_size: float = 0.7
    scenario: str = "default"


# Indicator names, their display order, and their place in the tree.
INDICATORS = {
    "Import size": 1,
    "Import gap": 2,
    "CAGR": 3,
    "GDP forecast": 4,
    "Tariff": 5,
    "Distance": 6,
}
HIERARCHY = {
    "Import size": ("Demand", "Trade", "Import size"),
    "Import gap": ("Demand", "Trade", "Import gap"),
    "CAGR": ("Demand", "Growth", "CAGR"),
    "GDP forecast": ("Demand", "Growth", "GDP forecast"),
    "Tariff": ("Barriers", "Tariff", ""),
    "Distance": ("Barriers", "Distance", ""),
}
# Shares of the first, flat version of the score.
FLAT_SHARES = {
    "cagr_n": 0.2,
    "gdp_n": 0.2,
    "tariff_n": 0.05,
    "dist_n": 0.05,
    "gap_n": 0.25,
    "size_n": 0.25,
}

WEIGHT_COLUMNS = ("w_demand", "w_trade", "w_tariff", "w_cagr", "w_size")


def _literal(w: Weights) -> Column:
    return F.struct(
        F.lit(w.scenario).alias("scenario"),
        F.lit(w.demand).alias("w_demand"),
        F.lit(w.trade).alias("w_trade"),
        F.lit(w.tariff).alias("w_tariff"),
        F.lit(w.cagr).alias("w_cagr"),
        F.lit(w.import_size).alias("w_size"),
    )


def with_scenarios(df: DataFrame, scenarios: list[Weights]) -> DataFrame:
    """Each row once per scenario; a row-local expansion, not a join."""
    if len(scenarios) == 1:
        return df.withColumn("__w", _literal(scenarios[0])).select(*df.columns, "__w.*")
    return df.select(*df.columns, F.inline(F.array(*[_literal(w) for w in scenarios])))


def with_slider(df: DataFrame, column: str, steps: int = 100) -> DataFrame:
    """Each row once per slider position 0, 1/steps, … 1 of one weight column."""
    if column not in WEIGHT_COLUMNS:
        raise ValueError(f"{column} is not a weight")
    positions = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i / F.lit(float(steps)))
    return df.withColumn(column, F.explode(positions))


def rest(weight: str) -> Column:
    return F.lit(1.0) - F.col(weight)


def leaf_weights() -> dict[str, Column]:
    """Weight of each indicator in the whole score, unrounded."""
    demand, trade = F.col("w_demand"), F.col("w_trade")
    return {
        "Import size": demand * trade * F.col("w_size"),
        "Import gap": demand * trade * rest("w_size"),
        "CAGR": demand * rest("w_trade") * F.col("w_cagr"),
        "GDP forecast": demand * rest("w_trade") * rest("w_cagr"),
        "Tariff": rest("w_demand") * F.col("w_tariff"),
        "Distance": rest("w_demand") * rest("w_tariff"),
    }


def ease(tariff: Column, distance: Column, share: Column) -> Column:
    """Ease of access. With both barriers known, one less their weighted mean; with
    one known, a half less its weighted value; with none, NULL."""
    burden = blank_sum(share * tariff, (F.lit(1.0) - share) * distance)
    base = F.when(tariff.isNotNull() & distance.isNotNull(), 1.0).otherwise(0.5)
    return base - burden


def score_tree(df: DataFrame) -> DataFrame:
    """Add the metrics of the score tree to a frame of indicators and weights.

    Needs size_n, gap_n, cagr_n, gdp_n, tariff_n, dist_n and the weight columns.
    """
    return (
        df.withColumn(
            "growth_metric",
            blank_sum(F.col("w_cagr") * F.col("cagr_n"), rest("w_cagr") * F.col("gdp_n")),
        )
        .withColumn(
            "market_metric",
            blank_sum(F.col("w_size") * F.col("size_n"), rest("w_size") * F.col("gap_n")),
        )
        .withColumn(
            "demand_metric",
            blank_sum(
                F.col("w_trade") * F.col("market_metric"),
                rest("w_trade") * F.col("growth_metric"),
            ),
        )
        .withColumn("ease_metric", ease(F.col("tariff_n"), F.col("dist_n"), F.col("w_tariff")))
        .withColumn(
            "market_score",
            F.round(
                blank_sum(
                    F.col("w_demand") * F.col("demand_metric"),
                    rest("w_demand") * F.col("ease_metric"),
                ),
                4,
            ),
        )
    )


def flat_score() -> Column:
    """The first version of the score: fixed shares, barriers added."""
    return blank_sum(*[F.lit(share) * F.col(c) for c, share in FLAT_SHARES.items()])


def indicator_breakdown(df: DataFrame) -> DataFrame:
    """Six rows per input row: indicator, order, raw text, scaled value, weight and
    their product. The barriers are shown as one less their scaled value."""
    scaled = {
        "Import size": F.col("size_n"),
        "Import gap": F.col("gap_n"),
        "CAGR": F.col("cagr_n"),
        "GDP forecast": F.col("gdp_n"),
        "Tariff": F.lit(1.0) - F.col("tariff_n"),
        "Distance": F.lit(1.0) - F.col("dist_n"),
    }
    texts = indicator_texts()
    weights = leaf_weights()

    def row(name: str) -> Column:
        weight = F.round(weights[name], 4)
        level1, level2, parameter = HIERARCHY[name]
        return F.struct(
            F.lit(name).alias("indicator"),
            F.lit(INDICATORS[name]).alias("indicator_order"),
            F.lit(level1).alias("level1"),
            F.lit(level2).alias("level2"),
            F.lit(parameter).alias("parameter"),
            texts[name].alias("value_text"),
            scaled[name].alias("value_normalized"),
            weight.alias("weight"),
            (weight * scaled[name]).alias("weighted_value"),
        )

    return df.select(
        "country_id", "name", "scenario", F.inline(F.array(*[row(n) for n in INDICATORS]))
    )


def indicator_texts() -> dict[str, Column]:
    """Raw indicator values with their units; shares are rounded before scaling."""

    def percent(c: str, factor: float) -> Column:
        return blank_text(plain_number(F.round(F.col(c), 2) * factor), "%")

    return {
        "Import size": blank_text(plain_number("import_size"), " tonnes"),
        "Import gap": blank_text(plain_number("import_gap"), " tonnes"),
        "CAGR": percent("import_CAGR", 100.0),
        "GDP forecast": percent("gdp_forecast_growth_avg", 1.0),
        "Tariff": percent("tariff_avg", 100.0),
        "Distance": blank_text(plain_number("dist"), " km"),
    }


def contribution_shares(breakdown: DataFrame, by: list[str]) -> DataFrame:
    """Each indicator's part of the summed weighted values of its group."""
    totals = breakdown.groupBy(*by).agg(F.sum("weighted_value").alias("__total"))
    return breakdown.join(totals, by).select(
        *by,
        "indicator",
        "indicator_order",
        "weighted_value",
        F.try_divide(F.col("weighted_value"), F.col("__total")).alias("share"),
    )


def weight_rollup(breakdown: DataFrame, weights: DataFrame, by: list[str]) -> DataFrame:
    """Weights and weighted values at every level of the indicator hierarchy.

    ``weights`` gives the weight columns per ``by``. Which weight a row shows
    depends on the levels it is grouped by: parameter, second, first, or none.
    """
    tree = breakdown.groupBy(
        *[F.col(c) for c in by], F.col("level1"), F.col("level2"), F.col("parameter")
    ).agg(F.sum("weighted_value").alias("wv"))
    path = ["level1", "level2", "parameter"]
    levels = tree.groupingSets([[*by, *path[:n]] for n in range(4)], *by, *path).agg(
        F.sum("wv").alias("weighted_value"), F.grouping_id().alias("__level")
    )
    kept = levels.join(weights.select(*by, *WEIGHT_COLUMNS), by)
    leaves = leaf_weights()
    by_parameter = F.when(F.lit(False), F.lit(0.0))
    for name, (_, _, parameter) in HIERARCHY.items():
        if parameter:
            by_parameter = by_parameter.when(
                F.col("parameter") == parameter, F.round(leaves[name], 4)
            )
    by_level2 = (
        F.when(F.col("level2") == "Trade", F.round(F.col("w_demand") * F.col("w_trade"), 4))
        .when(F.col("level2") == "Growth", F.round(F.col("w_demand") * rest("w_trade"), 4))
        .when(F.col("level2") == "Tariff", F.round(leaves["Tariff"], 4))
        .when(F.col("level2") == "Distance", F.round(leaves["Distance"], 4))
    )
    by_level1 = F.when(F.col("level1") == "Demand", F.round(F.col("w_demand"), 4)).when(
        F.col("level1") == "Barriers", F.round(rest("w_demand"), 4)
    )
    weight = (
        F.when(F.col("__level") == 0, by_parameter)
        .when(F.col("__level") == 1, by_level2)
        .when(F.col("__level") == 3, by_level1)
    )
    depth = (
        F.when(F.col("__level") == 0, 3).when(F.col("__level") == 1, 2).when(
            F.col("__level") == 3, 1
        )
    ).otherwise(0)
    return kept.select(
        *by,
        depth.alias("depth"),
        "level1",
        "level2",
        "parameter",
        weight.alias("weight"),
        "weighted_value",
    )


def barrier_parameter_weight(name: Column) -> Column:
    """Leaf weight for the two barrier indicators, NULL for the others."""
    leaves = leaf_weights()
    return F.when(name == "Tariff", F.round(leaves["Tariff"], 4)).when(
        name == "Distance", F.round(leaves["Distance"], 4)
    )


def split_columns() -> dict[str, Column]:
    """Both shares at each node of the tree, ready for display."""
    return {
        "demand_split": F.col("w_demand"),
        "barriers_split": F.round(rest("w_demand"), 2),
        "trade_split": F.col("w_trade"),
        "growth_split": F.round(rest("w_trade"), 2),
        "import_size_split": F.col("w_size"),
        "import_gap_split": F.round(rest("w_size"), 2),
        "cagr_split": F.col("w_cagr"),
        "gdp_split": F.round(rest("w_cagr"), 2),
        "tariff_split": F.col("w_tariff"),
        "distance_split": F.round(rest("w_tariff"), 2),
    }


def formula_texts() -> dict[str, Column]:
    """The score tree spelled out with the chosen weights.

    The wording is fixed text; the barrier formula names tariff and distance.
    """

    def two(c: Column) -> Column:
        return plain_number(F.round(c, 2))

    def four(c: Column) -> Column:
        return plain_number(F.round(c, 4))

    leaf = leaf_weights()
    w = F.col
    return {
        "weights_text": blank_text(
            "ImportSize: ", plain_number(leaf["Import size"]),
            " ImportGap: ", plain_number(leaf["Import gap"]),
            " CAGR: ", plain_number(leaf["CAGR"]),
            " GDP: ", plain_number(leaf["GDP forecast"]),
            " Tariff: ", four(leaf["Tariff"]),
            " Distance: ", four(leaf["Distance"]),
        ),
        "demand_ease_text": blank_text(
            "Demand: ", plain_number("w_demand"), " Ease: ", plain_number(rest("w_demand"))
        ),
        "score_text": blank_text(
            two(w("w_demand")), " * Popyt + ", two(rest("w_demand")), " * Bariery handlowe"
        ),
        "demand_text": blank_text(
            two(w("w_trade")), " * Handel + ", two(rest("w_trade")), " * Wzrost"
        ),
        "trade_text": blank_text(
            two(w("w_size")), " * Wielkość importu + ", two(rest("w_size")), " * Luka importowa"
        ),
        "growth_text": blank_text(
            two(w("w_cagr")), " * CAGR importu + ", two(rest("w_cagr")), " * Prognoza PKB"
        ),
        "barriers_text": blank_text(
            "1 - (", two(w("w_tariff")), " * Cło importowe + ", two(rest("w_tariff")),
            " * Dystans)",
        ),
        "whole_score_text": blank_text(
            four(leaf["Import size"]), " * Wielkość importu + ",
            four(leaf["Import gap"]), " * Luka importowa + ",
            four(leaf["CAGR"]), " * CAGR importu + ",
            four(leaf["GDP forecast"]), " * Prognoza PKB + ",
            four(rest("w_demand")), " - ( ",
            four(leaf["Tariff"]), " * Cło importowe + ",
            four(leaf["Distance"]), " * Dystans)",
        ),
    }
