"""Tables in parts, renewed by one switch, and the trade sums kept in one."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.plans import trade
from tradewind.sources.snapshots import Outrun, SnapshotTable

DAYS = [dt.date(2026, 3, d) for d in (2, 3, 4)]
LINES = (
    "flow string, marketing_year int, month_order int, member_state string, partner string, product_group string, "
    "product_weight_in_tonnes double, carcase_weight_in_tonnes double, value_in_thousand_euro double, created date"
)


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, f"{tmp_path}/t", "month string, n int", "month")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "month string, n int")


def test_parts_are_renewed_and_old_snapshots_stay_readable(spark, table):
    assert table.live().number == 0 and table.read().count() == 0
    first = table.renew(frame(spark, ("a", 1), ("b", 2), (None, 3)), {"a", "b", "none"}, table.live(), "x")
    second = table.renew(frame(spark, ("b", 5), ("c", 6)), {"b", "c", "none"}, first, "y")
    assert rows(table.read()) == [("a", 1), ("b", 5), ("c", 6)]
    assert rows(table.read(first)) == [("a", 1), ("b", 2), (None, 3)]
    assert (second.number, table.live().mark) == (2, "y")
    read = table.read(parts={"c"})
    assert rows(read) == [("c", 6)] and len(read.inputFiles()) == 1


def test_a_run_that_was_outrun_changes_nothing(spark, table):
    base = table.renew(frame(spark, ("a", 1)), {"a"}, table.live(), None)
    table.renew(frame(spark, ("a", 2)), {"a"}, base, None)
    with pytest.raises(Outrun):
        table.renew(frame(spark, ("a", 3)), {"a"}, base, None)
    assert rows(table.read()) == [("a", 2)]


def test_rows_of_other_parts_are_refused(spark, table):
    with pytest.raises(ValueError):
        table.renew(frame(spark, ("a", 1), ("b", 1)), {"a"}, table.live(), None)
    assert table.read().count() == 0


def test_cleaning_keeps_what_is_named(spark, table):
    for n in range(4):
        table.renew(frame(spark, ("a", n), *([("b", 0)] if not n else [])), {"a", "b"} if not n else {"a"}, table.live(), None)
    assert table.clean(keep=1) == 3
    assert rows(table.read()) == [("a", 3), ("b", 0)]


def lines(spark, *data):
    return spark.createDataFrame([("export", y, m, s, p, "pigs", w, w, None, c) for y, m, s, p, w, c in data], LINES)


def full(df):
    return rows(trade.trade_rows(df.drop("created")))


@pytest.fixture
def silver(spark):
    """Three days; the second opens a new year, so that one partner drops out; the third brings a
    late line of an old month, months that no calendar has, and a partner without a name."""
    return lines(
        spark,
        (2024, 1, "PL", "US", 1.0, DAYS[0]), (2024, 2, "PL", "US", 2.0, DAYS[0]), (2024, 2, "PL", "CN", 4.0, DAYS[0]),
        (2024, 2, None, "US", 3.0, DAYS[0]), (2024, 99, "PL", "US", 9.0, DAYS[0]),
        (2025, 1, "PL", "US", 8.0, DAYS[1]),
        (2024, 2, "PL", "US", 16.0, DAYS[2]), (2025, 13, "PL", "US", 5.0, DAYS[2]), (None, 3, "PL", "US", 6.0, DAYS[2]),
        (2025, 1, "PL", None, 7.0, DAYS[2]), (2025, 1, "DE", "CN", 7.0, DAYS[2]),
    )


def test_three_days_give_one_full_build(spark, silver, tmp_path):
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    for day in DAYS:
        known = silver.where(F.col("created") <= F.lit(day))
        for _ in range(2):  # a repeat changes nothing
            trade.refresh_trade(known, sums)
            assert rows(trade.trade_fact(sums)) == full(known)
    assert rows(trade.trade_fact(sums, sums.at(1))) == full(silver.where(F.col("created") == F.lit(DAYS[0])))


def test_lines_that_come_later_on_the_same_day(spark, silver, tmp_path):
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    trade.refresh_trade(silver.where("member_state <> 'DE' OR member_state IS NULL"), sums)
    trade.refresh_trade(silver, sums)
    assert rows(trade.trade_fact(sums)) == full(silver)


def test_a_rebuild_sees_lines_taken_out(spark, silver, tmp_path):
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    trade.refresh_trade(silver, sums)
    less = silver.where("marketing_year = 2024")
    trade.refresh_trade(less, sums, rebuild=True)
    assert rows(trade.trade_fact(sums)) == full(less)


def test_the_view_shows_the_fact(spark, silver, tmp_path, database):
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    for day in DAYS:
        known = silver.where(F.col("created") <= F.lit(day))
        trade.publish_trade(sums, trade.refresh_trade(known, sums), f"{database}.fact")
        assert rows(spark.table(f"{database}.fact")) == full(known)
    empty = trade.trade_sums(spark, f"{tmp_path}/none")
    trade.publish_trade(empty, trade.refresh_trade(silver.limit(0), empty), f"{database}.fact")
    assert spark.table(f"{database}.fact").count() == 0


def test_nothing_new_publishes_nothing(spark, silver, tmp_path):
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    first = trade.refresh_trade(silver, sums)
    again = trade.refresh_trade(silver.where(F.col("created") < F.lit(DAYS[2])), sums)
    assert again == first
    empty = trade.trade_sums(spark, f"{tmp_path}/none")
    trade.refresh_trade(silver.limit(0), empty)
    assert empty.read().count() == 0


def test_only_touched_months_are_read_and_written(spark, silver, tmp_path):
    """The scan of the second run prunes years; the other months keep their folders."""
    path = f"{tmp_path}/silver"
    silver.write.partitionBy("marketing_year").parquet(path)
    held = spark.read.schema(LINES).parquet(path)
    sums = trade.trade_sums(spark, f"{tmp_path}/sums")
    first = trade.refresh_trade(held.where(F.col("created") <= F.lit(DAYS[0])), sums)
    months = trade.touched_months(held.where(F.col("created") <= F.lit(DAYS[1])), DAYS[1].isoformat())
    assert months == ({(2025, 1)}, DAYS[1].isoformat())
    months, _ = months
    scan = trade._of_months(held, months)
    files = [r.f for r in scan.select("month_order", F.input_file_name().alias("f")).collect()]
    assert files and all("marketing_year=2025" in f for f in files)
    assert "PartitionFilters: [" in scan._jdf.queryExecution().executedPlan().toString()
    second = trade.refresh_trade(held.where(F.col("created") <= F.lit(DAYS[1])), sums)
    # The first day counts again; the month opened on the second day is new.
    assert set(second.folders) == {*first.folders, "2025-01"}
    snapshot = json.load(open(f"{tmp_path}/sums/snapshots/{second.number:012d}.json"))
    assert snapshot["mark"] == DAYS[1].isoformat() and os.path.isdir(f"{tmp_path}/sums/{snapshot['folders']['2025-01']}")
