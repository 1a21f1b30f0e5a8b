import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind.operators import lookup, scoring
from tradewind.operators.scoring import Weights
from tradewind.plans import reports

COLUMNS = (
    "country_id int, name string, size_n double, gap_n double, cagr_n double, gdp_n double, "
    "tariff_n double, dist_n double, import_size double, import_gap double, import_CAGR double, "
    "gdp_forecast_growth_avg double, tariff_avg double, dist double"
)


def frame(spark, *indicators):
    raw = (1234.5, -200.0, 0.1234, 2.345, 0.0512, 7000.0)
    return spark.createDataFrame(
        [(i + 1, f"N{i + 1}", *values, *raw) for i, values in enumerate(indicators)], COLUMNS
    )


FULL = (0.8, 0.4, 0.6, 0.2, 0.5, 0.3)
NONE = (None,) * 6
DEMAND = (0.8, 0.4, 0.6, 0.2, None, None)
EASE = (None, None, None, None, 0.5, 0.3)


def test_score_tree(spark):
    scored = {
        r["name"]: r for r in reports.scores(frame(spark, FULL, NONE, DEMAND, EASE)).collect()
    }
    full = scored["N1"]
    growth, market = 0.5 * 0.6 + 0.5 * 0.2, 0.7 * 0.8 + 0.3 * 0.4
    demand, ease = 0.7 * market + 0.3 * growth, 1 - (0.5 * 0.5 + 0.5 * 0.3)
    assert full["growth_metric"] == pytest.approx(growth)
    assert full["market_metric"] == pytest.approx(market)
    assert full["demand_metric"] == pytest.approx(demand)
    assert full["ease_metric"] == pytest.approx(ease)
    assert full["market_score"] == pytest.approx(round(0.9 * demand + 0.1 * ease, 4))
    assert scored["N2"]["market_score"] is None
    assert scored["N3"]["ease_metric"] is None
    assert scored["N3"]["market_score"] == pytest.approx(round(0.9 * demand, 4))
    assert scored["N4"]["market_score"] == pytest.approx(round(0.1 * ease, 4))


def test_ease_with_one_barrier(spark):
    cases = frame(spark, (None,) * 4 + (0.5, None), (None,) * 4 + (None, 0.2))
    got = [r["ease_metric"] for r in reports.scores(cases).orderBy("country_id").collect()]
    assert got == [pytest.approx(0.5 - 0.5 * 0.5), pytest.approx(0.5 - 0.5 * 0.2)]


def test_flat_score(spark):
    got = frame(spark, FULL, EASE, NONE).select(scoring.flat_score().alias("s")).collect()
    assert got[0]["s"] == pytest.approx(0.2 * 0.6 + 0.2 * 0.2 + 0.05 * 0.8 + 0.25 * 1.2)
    assert got[1]["s"] == pytest.approx(0.05 * 0.8)
    assert got[2]["s"] is None


def test_breakdown_adds_up(spark):
    df = scoring.with_scenarios(frame(spark, FULL), [Weights(), Weights(0.5, 0.5, 0.5, 0.5, 0.5, "even")])
    broken = scoring.indicator_breakdown(df)
    assert broken.count() == 12
    for r in broken.groupBy("scenario").agg(F.sum("weight").alias("w"), F.sum("weighted_value").alias("v")).collect():
        assert r["w"] == pytest.approx(1.0, abs=1e-3)
    score = reports.scores(frame(spark, FULL)).first()["market_score"]
    default = broken.where("scenario = 'default'").agg(F.sum("weighted_value")).first()[0]
    assert default == pytest.approx(score, abs=1e-3)
    detail = reports.partner_detail(broken.where("scenario = 'default'"), "N1").collect()
    assert [r["indicator"] for r in detail] == list(scoring.INDICATORS)
    assert [r["value_text"] for r in detail] == [
        "1234.5 tonnes", "-200 tonnes", "12%", "2.35%", "5%", "7000 km",
    ]
    assert detail[4]["value_normalized"] == pytest.approx(0.5)
    assert detail[5]["value_normalized"] == pytest.approx(0.7)
    shares = scoring.contribution_shares(broken, ["country_id", "scenario"])
    for r in shares.groupBy("scenario").agg(F.sum("share").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)


def test_blank_texts(spark):
    empty = frame(spark, FULL).withColumn("import_CAGR", F.lit(None).cast("double"))
    broken = scoring.indicator_breakdown(scoring.with_scenarios(empty, [Weights()]))
    texts = dict(broken.select("indicator", "value_text").collect())
    assert texts["CAGR"] == "%"


def test_rollup_levels(spark):
    df = scoring.with_scenarios(frame(spark, FULL), [Weights()])
    broken = scoring.indicator_breakdown(df)
    weights = df.select("country_id", "scenario", *scoring.WEIGHT_COLUMNS)
    got = {
        (r["depth"], r["level1"], r["level2"], r["parameter"]): r["weight"]
        for r in scoring.weight_rollup(broken, weights, ["country_id", "scenario"]).collect()
    }
    assert len(got) == 1 + 2 + 4 + 6
    assert got[(0, None, None, None)] is None
    assert got[(1, "Demand", None, None)] == pytest.approx(0.9)
    assert got[(1, "Barriers", None, None)] == pytest.approx(0.1)
    assert got[(2, "Demand", "Trade", None)] == pytest.approx(0.63)
    assert got[(2, "Barriers", "Tariff", None)] == pytest.approx(0.05)
    assert got[(3, "Demand", "Trade", "Import size")] == pytest.approx(0.441)
    assert got[(3, "Barriers", "Distance", "")] is None


def test_slider(spark):
    df = scoring.with_slider(scoring.with_scenarios(frame(spark, FULL), [Weights()]), "w_demand")
    got = sorted(r["w_demand"] for r in df.collect())
    assert len(got) == 101 and got[90] == 0.9 and got[-1] == 1.0
    with pytest.raises(ValueError):
        scoring.with_slider(df, "name")


def test_texts_and_splits(spark):
    df = scoring.with_scenarios(spark.range(1), [Weights()])
    texts = df.select(*[c.alias(n) for n, c in scoring.formula_texts().items()]).first()
    assert texts["weights_text"] == (
        "ImportSize: 0.441 ImportGap: 0.189 CAGR: 0.135 GDP: 0.135 Tariff: 0.05 Distance: 0.05"
    )
    assert texts["barriers_text"] == "1 - (0.5 * Cło importowe + 0.5 * Dystans)"
    splits = df.select(*[c.alias(n) for n, c in scoring.split_columns().items()]).first()
    assert splits["barriers_split"] == 0.1 and splits["growth_split"] == 0.3


def test_best_markets_keeps_ties(spark):
    scored = spark.createDataFrame(
        [(i, f"N{i}", s) for i, s in enumerate([0.9] + [0.5] * 13 + [0.1, None])],
        "country_id int, name string, market_score double",
    )
    assert reports.best_markets(scored, 12).count() == 14


MARKET = "country_id int, year int, import_tonnes double, import_gap double, consumption_tones long, production_tonnes double"


def test_latest_values(spark):
    market = spark.createDataFrame(
        [
            (1, 2022, 10.0, 1.0, 5, 4.0), (2, 2022, 20.0, 2.0, 5, 3.0), (2, 2021, 21.0, 3.0, 5, 2.0),
            (3, 2021, 30.0, 4.0, 5, 1.0), (9, 2023, 90.0, 5.0, 5, 0.0), (1, 2024, 11.0, None, 5, None),
            (2, 2023, 22.0, 6.0, None, 1.0),
        ],
        MARKET,
    )
    partners = spark.createDataFrame(
        [(1, "A", 0), (2, "B", 1), (3, "C", 0)], "country_id int, name string, faostat_fallback int"
    )
    # Country 9 is no partner, yet it sets the usable year.
    got = lookup.latest_values(market, partners, {"import_tonnes": "size"})
    assert rows(got) == [(1, None), (2, 20.0), (3, None)]
    assert rows(reports.history(market, partners, "import_gap", 2)) == [("B", 2023, 6.0)]
    assert rows(lookup.gap_of_year(market, 2023, ["country_id"])) == [(2, -1.0), (9, 5.0)]
    assert lookup.largest_gap_of_year(market, 2021).first()[0] == 4.0


def test_names_to_codes(spark):
    aliases = spark.createDataFrame([("Poland", "POL"), ("Polska", "POL"), ("poland", "POL")], "alias string, iso3 string")
    df = spark.createDataFrame([(" POLAND ",), ("Polska",), ("Atlantis",), (None,)], "c string")
    coded = lookup.names_to_codes(df, aliases, {"c": "code"})
    assert rows(coded) == [(" POLAND ", "POL"), ("Atlantis", None), ("Polska", "POL"), (None, None)]
    assert rows(lookup.unmatched_names(coded, {"c": "code"})) == [("c", "Atlantis", 1), ("c", None, 1)]
