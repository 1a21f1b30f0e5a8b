"""Runs that are repeated, files of one JSON array each, facts laid out by year, dates per source."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.plans import cleaning
from tradewind.sources import landing, tables
from tradewind.sources.ledger import RunLedger
from tradewind.streaming import landed_files

DAY = dt.date(2026, 3, 12)
PAIRS = "k int, v string"


def test_repeated_run_appends_nothing(spark, database):
    ledger, table = RunLedger(f"{database}.runs"), f"{database}.log"
    some = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], PAIRS)
    assert ledger.append_once(some, table, PAIRS, "r1")
    assert not ledger.append_once(some, table, PAIRS, "r1")
    assert ledger.append_once(some, table, PAIRS, "r1", 1)
    assert ledger.append_once(spark.createDataFrame([], PAIRS), table, PAIRS, "r2")
    got = spark.table(table).groupBy("run_id", "batch_id").count()
    assert rows(got) == [("r1", 0, 3), ("r1", 1, 3)]
    assert spark.table(ledger.name).count() == 3


def test_run_that_died_before_its_mark_is_replaced(spark, database, monkeypatch):
    ledger, table = RunLedger(f"{database}.runs"), f"{database}.log"

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(RunLedger, "record", lost)
        with pytest.raises(RuntimeError):
            ledger.append_once(spark.createDataFrame([(1, "half")], PAIRS), table, PAIRS, "r1")
    assert ledger.append_once(spark.createDataFrame([(1, "whole")], PAIRS), table, PAIRS, "r1")
    assert rows(spark.table(table).select("k", "v")) == [(1, "whole")]


def test_validation_is_logged_once(spark, tmp_path, database):
    log, ledger = f"{database}.validation_logs", RunLedger(f"{database}.runs")

    def write(dataset, text):
        folder = tmp_path / cleaning.YEARLY[dataset].landed
        folder.mkdir(exist_ok=True)
        open(landing.landing_path(str(tmp_path), cleaning.YEARLY[dataset].landed, DAY), "w").write(text)

    def validate():
        cleaning.validate_landed(spark, str(tmp_path), DAY, log, ledger)

    write("production", ",".join(cleaning.expected_columns("production")) + "\nPoland,POL,2020,5.5\n")
    for _ in range(2):
        with pytest.raises(quality.ValidationStopped):
            validate()
    for dataset in ("import", "consumption"):
        write(dataset, ",".join(cleaning.expected_columns(dataset)) + "\nPoland,POL,2020,5.5\n")
    for _ in range(2):
        validate()
    got = spark.table(log).groupBy("batch_id", "severity").count()
    assert rows(got) == [(-1, "ERROR", 1), (-1, "SUCCESS", 1), (0, "SUCCESS", 3)]


def test_stream_batch_repeated_after_failure(spark, tmp_path, database, monkeypatch):
    """Rows without a key come once although their batch is run twice."""
    table, ledger, root = f"{database}.t", RunLedger(f"{database}.runs"), tmp_path / "land"
    os.makedirs(root / "s")
    open(root / "s" / "s_2026-03-12.json", "w").write(json.dumps([{"k": 1, "v": "a"}, {"k": None, "v": "b"}]))

    def run():
        stream = landed_files.stream_files(spark, str(root), "s", "json", PAIRS)
        landed_files.merge_stream(
            stream, lambda df: df, table, PAIRS, ["k"], f"{tmp_path}/checkpoint", ledger=ledger
        ).awaitTermination()

    kept = RunLedger.record

    def record(self, session, name, *more):
        if name == table:
            raise RuntimeError("driver lost")
        kept(self, session, name, *more)

    with monkeypatch.context() as patch:
        patch.setattr(RunLedger, "record", record)
        with pytest.raises(Exception, match="driver lost"):
            run()
    run()
    run()
    for name in (table, f"{table}_unkeyed"):
        spark.catalog.refreshTable(name)
    assert rows(landed_files.with_unkeyed(spark, table, PAIRS)) == [(1, "a"), (None, "b")]


ODD = [
    {"id": 1, "t": 'brace } and { "quoted" \\', "in": {"a": [1, 2]}, "more": [{"b": "}, {"}, {"b": None}]},
    {"id": 2, "t": "", "in": {"a": []}, "more": []},
    {"id": 3, "t": "[[[" * 40 + "é \\\\", "in": None, "more": [{"b": "\"},\n{\""}]},
    {"id": None, "t": None, "in": {"a": None}, "more": None},
    {"id": 5, "t": "}" * 300, "in": {"a": [7]}, "more": [{"b": "x"}] * 9},
]
LAYOUT = "id bigint, t string, `in` struct<a array<int>>, more array<struct<b string>>"


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
@pytest.mark.parametrize("block", ["64", "333", "128MB"])
def test_json_array_read_by_blocks(spark, tmp_path, style, block):
    """As the reader that takes a file whole, whatever the blocks cut through."""
    for n in (1, 3):
        given = [dict(r, id=r["id"] and r["id"] + 10 * k) for k in range(n * 4) for r in ODD]
        open(tmp_path / f"a{n}.json", "w").write(json.dumps(given, **style))
    with_conf = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        got = landing.read_json_array(spark, str(tmp_path), LAYOUT)
        assert rows(got) == rows(landing.read_json(spark, str(tmp_path), LAYOUT))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_json_array_edges(spark, tmp_path):
    def read(text):
        path = str(tmp_path / "one.json")
        open(path, "w").write(text)
        return rows(landing.read_json_array(spark, path, "k int"))

    assert read("") == read("[]") == read(" [ \n ] ") == read("[null]") == []
    assert read('[null, {"k": 1}, null, null,\n{"k": 2}]\n') == [(1,), (2,)]
    assert read('[{"k": 1}, {"k": 2}, {"k": ') == [(1,), (2,), (None,)]
    assert read('[{"k": "no number"}, {}]') == [(None,), (None,)]


def test_json_array_is_split(spark, tmp_path):
    """One file, several tasks."""
    path = str(tmp_path / "big.json")
    open(path, "w").write(json.dumps([{"k": i} for i in range(5000)]))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "8192")
    try:
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 4
        got = landing.read_json_array(spark, path, "k int").agg(F.count("k"), F.sum("k"), F.countDistinct("k"))
        assert rows(got) == [(5000, 12497500, 5000)]
    finally:
        spark.conf.set(size, before)


def test_landed_arrays_stay_small(spark, tmp_path, monkeypatch):
    """More files, not longer ones, for more rows; all rows come back."""
    monkeypatch.setattr(landing, "FILE_BYTES", 4096)
    few, many = (spark.range(n).selectExpr("id AS k", "repeat('x', 60) AS t") for n in (100, 8000))
    longest = []
    for name, frame in (("few", few), ("many", many)):
        path = landing.land_arrays(frame, str(tmp_path / name))
        files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
        longest.append(max(map(os.path.getsize, files)))
        assert sorted(r["k"] for f in files for r in json.load(open(f))) == list(range(frame.count()))
        assert rows(landing.read_json_array(spark, path, "k bigint, t string")) == rows(frame)
    assert longest[1] < 3 * 4096


def test_latest_year_reads_its_folders_only(spark, tmp_path):
    fact = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 50 <> 0 THEN CAST(2000 + id % 8 AS int) END AS year",
        "CASE WHEN id % 8 < 6 THEN id * 1.0D END AS v",
    )
    path = str(tmp_path / "fact")
    tables.write_by(fact, path, "year", "v")
    latest = tables.latest_of(spark, path, "year")
    assert rows(latest.select("year").distinct()) == [(2005,)]
    assert latest.count() == fact.where("year = 2005").count()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    assert scan.startswith("isnotnull(year") and "ubquery" in scan
    opened = latest.select(F.input_file_name()).distinct().collect()
    assert opened and all("year=2005" in r[0] for r in opened)
    both = tables.latest_of(spark, path, "year", back=1)
    assert rows(both.select("year").distinct()) == [(2004,), (2005,)]
    tables.write_by(fact.withColumn("v", F.lit(None).cast("double")), path, "year", "v")
    assert tables.latest_of(spark, path, "year").count() == 0
    tables.write_by(fact.limit(0), str(tmp_path / "none"), "year", "v")


def test_a_date_per_source(spark, tmp_path):
    def put(key, day):
        path = landing.landing_path(str(tmp_path), key, day)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "w").write("x")

    later = dt.date(2026, 4, 1)
    put("distance", DAY), put("population", DAY), put("population", later)
    root, keys = str(tmp_path), ["distance", "population"]
    paths, day = landing.landed_paths(spark, root, keys, None)
    assert day == later
    assert paths["distance"].endswith(f"{DAY}.csv") and paths["population"].endswith(f"{later}.json")
    paths, day = landing.landed_paths(spark, root, keys, {"population": DAY})
    assert paths["population"].endswith(f"{DAY}.json") and day == DAY
    with pytest.raises(FileNotFoundError, match="distance"):
        landing.landed_paths(spark, root, keys, later)
    with pytest.raises(FileNotFoundError):
        landing.landed_paths(spark, root, [*keys, "pork_tariff"], None)
