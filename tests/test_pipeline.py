"""From landed files to both models, and the incremental run."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind.plans import cleaning, market, reports, trade
from tradewind.schemas import MARKET, SILVER, TRADE, conform, layout, too_long
from tradewind.sources import landing, reference, tables
from tradewind.streaming import landed_files

DAY = dt.date(2026, 3, 8)
NEXT = dt.date(2026, 3, 9)

COUNTRIES = [
    ("BEL", "Belgium", True), ("CHN", "China", False), ("JPN", "Japan", False),
    ("POL", "Poland", True), ("USA", "United States", False), ("VNM", "Vietnam", False),
]
ALIASES = [(name, code) for code, name, _ in COUNTRIES] + [("Viet Nam", "VNM")]


def put(root, key, day, text):
    folder = root / key
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{key}_{day}.{landing.LANDED[key]}").write_text(text)


def price(state, begin, end, value, cls="Average S + E"):
    return {
        "memberStateCode": state[:2].upper(), "memberStateName": state, "beginDate": begin,
        "endDate": end, "price": value, "unit": "€/100 kg", "weekNumber": 1, "pigClass": cls,
    }


def csv(header, lines):
    return "\n".join([",".join(header), *[",".join("" if v is None else str(v) for v in x) for x in lines]]) + "\n"


def yearly(dataset, lines):
    return csv(cleaning.expected_columns(dataset), lines)


def land_all(root, day):
    put(root, "ue_pork_prices", day, json.dumps([
        price("Poland", "29/01/2024", "04/02/2024", "€180.5"),
        price("Belgium", "01/01/2024", "07/01/2024", "€170.25"),
        price("Belgium", "01/01/2024", "07/01/2024", "€1.0", "Class E"),
        price("Belgium", "junk", "07/01/2024", "€170.25"),
    ], indent=4))
    put(root, "ue_pork_production", day, json.dumps([
        {"memberStateCode": "PL", "memberStateName": "Poland", "month": "February", "year": 2024,
         "heads": 100.0, "kgPerHead": 90.5, "tonnes": 9.0},
        {"memberStateCode": "BE", "memberStateName": "Belgium", "month": "January", "year": 2024,
         "heads": 50.0, "kgPerHead": 95.0, "tonnes": 4.0},
        {"memberStateCode": "BE", "memberStateName": "Belgium", "month": "January", "year": 2010,
         "heads": 5.0, "kgPerHead": 95.0, "tonnes": 400.0},
    ]))
    names = list(cleaning.TRADE_NAMES)
    def line(flow, year, order, state, partner, weight):
        return (flow, year, "Month", order, f"{year}-{order}", state, partner, "Pigmeat", "0203", weight, weight * 2, 7)
    put(root, "pigs_trade_export", day, csv(names, [
        line("export", 2024, 1, "Poland", "China", 10.5), line("export", 2024, 3, "Poland", "China", 1.5),
        line("export", 2023, 2, "Poland", "Japan", 2.5), line("export", 2023, 12, "Belgium", "China", 4.5),
    ]))
    put(root, "pigs_trade_import", day, csv(names, [line("import", 2024, 2, "Poland", "Vietnam", 3.0)]))
    tariff = list(cleaning.TARIFF_NAMES)
    put(root, "pork_tariff", day, csv(tariff, [
        ("China", "Poland", 2023, "HS", "0203", "Pork", 4, "MFN", 0.12),
        ("China", "Belgium", 2023, "HS", "0203", "Pork", 4, "MFN", 0.08),
        ("Viet Nam", "Poland", 2023, "HS", "0203", "Pork", 4, "MFN", 0.2),
        ("Atlantis", "Poland", 2023, "HS", "0203", "Pork", 4, "MFN", 0.5),
        ("China", "Japan", 2023, "HS", "0203", "Pork", 4, "MFN", 9.0),
    ]))
    put(root, "distance", day, csv(["iso_o", "iso_d", "contig", "dist"], [
        ("POL", "CHN", ".", 7000), ("POL", "JPN", ".", 8500.5), ("POL", "USA", "0", "."),
        ("POL", "BEL", "0", 1100), ("BEL", "CHN", "0", 7900), ("POL", "VNM", "0", 8000),
    ]))
    years = range(2017, 2024)
    codes = [(n, c) for c, n, _ in COUNTRIES]
    put(root, "pork_production", day, yearly("production", [(n, c, y, 100.5 * (i + 1)) for i, (n, c) in enumerate(codes) for y in years] + [("Europe", None, 2022, 9)]))
    put(root, "pork_import", day, yearly("import", [(n, c, y, round(50 * (i + 1) * 1.1 ** (y - 2017), 3)) for i, (n, c) in enumerate(codes) for y in years if c != "VNM" or y > 2020]))
    put(root, "pork_consumption", day, yearly("consumption", [(n, c, y, f"{180 * (i + 1)}.0") for i, (n, c) in enumerate(codes) for y in years]))
    put(root, "pork_domestic_supply", day, yearly("domestic_supply", [("Poland", "POL", 2022, 7)]))
    put(root, "gdp_growth", day, csv(["entity", "code", "year", *cleaning.YEARLY["gdp_growth"].renames], [(n, c, y, None, 1.5 * (i + 1), None, "note") for i, (n, c) in enumerate(codes) for y in (2026, 2027)]))
    for key in ("population", "gdp_per_capita"):
        put(root, key, day, json.dumps([
            {"country": {"id": "PL", "value": "Poland"}, "countryiso3code": "POL", "date": "2023", "value": 38000000.7},
            {"country": {"id": "1A", "value": "Arab World"}, "countryiso3code": "ARB", "date": "2023", "value": None},
        ]))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Both models, filled twice from the same day's files."""
    root = tmp_path_factory.mktemp("landing")
    where = tmp_path_factory.mktemp("warehouse")
    names = {k: f"pipe_{k}" for k in ("silver", "market", "trade")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE {name} LOCATION '{where}/{name}'")
    land_all(root, DAY)
    aliases = spark.createDataFrame(ALIASES, "alias string, iso3 string")
    countries = spark.createDataFrame(COUNTRIES, "iso3 string, name string, eu boolean")
    for _ in range(2):
        cleaning.run_cleaning(spark, str(root), names["silver"], DAY, aliases, ["iso_o", "iso_d", "contig", "dist"])
        trade.run_trade(spark, names["silver"], names["trade"], DAY)
    market.run_market(spark, names["silver"], names["market"], countries, F.col("eu"), "POL")
    yield names
    for name in names.values():
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_cleaned_tables(spark, built):
    def silver(name):
        return spark.table(f"{built['silver']}.{name}")

    for name, ddl in SILVER.items():
        kept = silver(name).drop("contig")  # the distance table keeps all columns of its sheet
        assert sorted(kept.dtypes) == sorted(conform(silver(name), ddl).dtypes), name
    prices = silver("prices_silver").where("pig_class = 'Average S + E'")
    assert rows(prices.select("member_state_name", "price", "year_week", "month_number", "created")) == [
        ("Belgium", 170.25, "202401", 1, DAY), ("Poland", 180.5, "202405", 2, DAY),
    ]
    assert silver("trade_silver").count() == 5
    assert rows(silver("consumption").where("code = 'POL' AND year = 2020").select("consumption_tones", "key")) == [(720, "Poland_2020")]
    assert rows(silver("tariff").where("reporting_country = 'Atlantis'").select("reporting_country_iso3", "partner_country_iso3")) == [(None, "POL")]
    assert rows(silver("population")) == [("Arab World", "ARB", 2023, None), ("Poland", "POL", 2023, 38000000)]
    assert rows(silver("distance").select("iso_o", "iso_d", "dist").where("iso_d = 'USA'")) == [("POL", "USA", None)]


def test_trade_model(spark, built):
    def fact(name):
        return spark.table(f"{built['trade']}.{name}")

    for name, ddl in TRADE.items():
        assert fact(name).schema == layout(ddl), name
    # Japan has no trade in the latest year and drops out.
    assert rows(fact("fact_trade").select("trade_key", "partner", "flow", "product_weight_in_tonnes", "last_month")) == [
        ("Belgium-2023-12", "China", "export", 4.5, 3),
        ("Poland-2024-01", "China", "export", 10.5, 3),
        ("Poland-2024-02", "Vietnam", "import", 3.0, 2),
        ("Poland-2024-03", "China", "export", 1.5, 3),
    ]
    assert rows(fact("fact_prices").select("prices_key", "price", "week_number")) == [
        ("Belgium-2024-01", 170.25, 1), ("Poland-2024-02", 180.5, 5),
    ]
    assert rows(fact("fact_production").select("prod_key", "tonnes", "country_group")) == [
        ("Belgium-2010-01", 400000.0, "Belgium"), ("Belgium-2024-01", 4000.0, "Belgium"),
        ("Poland-2024-02", 9000.0, "Poland"),
    ]
    assert fact("bridge_member_date").count() == 6
    assert rows(fact("dim_date").where("year = 2010")) == [("2010-01", 2010, 1, "January", "Jan", 201001)]
    assert too_long(fact("fact_trade"), {"flow": 5}).first()["n_too_long"] == 4


def test_market_model(spark, built):
    def fact(name):
        return spark.table(f"{built['market']}.{name}")

    for name, ddl in MARKET.items():
        assert fact(name).schema == layout(ddl), name
    assert fact("dim_calendar").count() == 13
    assert [r["iso3"] for r in fact("dim_partner").orderBy("country_id").collect()] == ["CHN", "JPN", "USA", "VNM"]
    assert fact("dim_partner").where("faostat_fallback = 1").first()["iso3"] == "JPN"
    poland = fact("fact_pork_market").where("country_id = 4 AND year = 2020").first()
    assert poland["import_gap"] == pytest.approx(720 - 402)
    assert poland["import_gap_normalized"] == pytest.approx((4 - 1) / (6 - 1))
    assert fact("fact_production").where("year = 2022").count() == 6  # the continent is gone
    growth = {r["country_id"]: r for r in fact("fact_pork_market_growth").collect()}
    assert growth[1]["import_CAGR"] == pytest.approx(0.1, abs=1e-4)
    assert growth[6]["import_CAGR"] is None and growth[6]["gdp_growth_forecast_normalized"] == 1.0
    barriers = {r["country_id"]: r for r in fact("fact_trade_barriers").collect()}
    assert barriers[2]["tariff_avg"] == pytest.approx(0.1)
    assert None in barriers  # the unknown reporter
    assert barriers[3]["dist_normalized"] == 1.0 and barriers[2]["dist_normalized"] == 0.0
    partners = fact("dim_partner")
    scored = reports.scores(
        reports.indicators(partners, fact("fact_pork_market"), fact("fact_pork_market_growth"), fact("fact_trade_barriers"))
    )
    best = reports.best_markets(scored, 2).collect()
    assert len(best) == 2
    assert scored.count() == 4
    assert scored.where("market_score < 0 OR market_score > 1").count() == 0


def test_snapshots(spark, tmp_path):
    for day in (DAY, NEXT):
        put(tmp_path, "pork_import", day, yearly("import", [("Poland", "POL", 2020, day.day)]))
    assert landing.latest_date(spark, str(tmp_path), "pork_import") == NEXT
    both = landing.read_csv(spark, f"{tmp_path}/pork_import/*.csv", cleaning.expected_columns("import"))
    dated = landing.with_file_date(both)
    assert {r["ingestion_date"] for r in dated.collect()} == {DAY, NEXT}
    assert [r["ingestion_date"] for r in landing.latest_snapshot(dated).collect()] == [NEXT]
    with pytest.raises(Exception):
        landing.latest_date(spark, str(tmp_path), "distance")


def test_corrupt_rows_are_kept_aside(spark, tmp_path):
    put(tmp_path, "pork_import", DAY, "entity,code\nPoland,POL\nToo,many,values\n")
    path = landing.landing_path(str(tmp_path), "pork_import", DAY)
    got = landing.read_csv(spark, path, ["entity", "code"], keep_corrupt=True)
    assert rows(got) == [("Poland", "POL", None), ("Too", "many", "Too,many,values")]


def test_payload(spark):
    docs = ['[{"page":1},[{"a":{"b":"x"},"n":1},{"n":2}]]', '[{"message":"no"}]', "[{},null]", "not json", None]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, doc string")
    got = landing.unwrap_payload(df, "doc", {"b": "$.a.b string", "n": "$.n bigint"})
    assert rows(got) == [(0, None, 2), (0, "x", 1)] or rows(got) == [(0, "x", 1), (0, None, 2)]


def test_reference_tables(spark):
    assert reference.slider_positions(spark).count() == 101
    assert rows(reference.indicator_table(spark))[0] == ("CAGR", 3)
    assert reference.hierarchy_table(spark).where("Parameter = ''").count() == 2


def test_country_list(spark, tmp_path):
    (tmp_path / "c.csv").write_text("ISO3,name_short,EU\nPOL,Poland,EU\nUSA,United States,\n")
    got = reference.country_list(spark, f"{tmp_path}/c.csv")
    assert rows(got) == [("POL", "Poland", True), ("USA", "United States", False)]


def test_staging_is_cleared(spark, monkeypatch, tmp_path):
    from tradewind.operators import staging

    monkeypatch.setattr(staging, "staging_root", lambda _: f"{tmp_path}/staged")
    kept = staging.materialise(spark.range(4))
    assert kept.count() == 4
    staging.clear_staging(spark)
    assert not (tmp_path / "staged").exists()


def test_file_stream(spark, tmp_path, database):
    """Each landed file is merged once; a second run finds nothing new."""
    table = f"{database}.production_silver"
    root = tmp_path / "land"

    def month(tonnes, name):
        return json.dumps([{"memberStateCode": "PL", "memberStateName": "Poland", "month": name,
                            "year": 2024, "heads": 1.0, "kgPerHead": 1.0, "tonnes": tonnes}])

    def run():
        stream = landed_files.stream_files(spark, str(root), "ue_pork_production", "json", cleaning.RAW_PRODUCTION)
        landed_files.merge_stream(
            stream, lambda df: cleaning.clean_production(df, DAY), table, SILVER["production_silver"],
            cleaning.MERGE_KEYS["production_silver"], f"{tmp_path}/checkpoint",
        ).awaitTermination()
        spark.catalog.refreshTable(table)
        return rows(spark.table(table).select("month", "tonnes"))

    put(root, "ue_pork_production", DAY, month(1.0, "May"))
    assert run() == [("May", 1.0)]
    put(root, "ue_pork_production", NEXT, month(9.0, "May"))  # a known key keeps its value
    put(root, "ue_pork_production", dt.date(2026, 3, 10), month(2.0, "June"))
    assert run() == [("June", 2.0), ("May", 1.0)]
    assert run() == [("June", 2.0), ("May", 1.0)]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1), "id bigint, other string")


def test_overwrite_path(spark, tmp_path):
    tables.overwrite_path(spark.range(3), f"{tmp_path}/x")
    tables.overwrite_path(spark.range(2), f"{tmp_path}/x")
    assert spark.read.parquet(f"{tmp_path}/x").count() == 2
