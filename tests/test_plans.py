"""Properties of physical plans that matter on large inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tradewind.operators import merge, ordering, quality, scaling, staging
from tradewind.plans import cleaning, trade
from tradewind.sources import landing

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture
def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_columns_are_pruned(orders):
    text = plan(scaling.minmax_overall(orders.select("o_orderkey", "o_totalprice"), "o_totalprice"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "ReadSchema: struct<o_totalprice:double>" in text
    assert "o_orderpriority" not in text


def test_filter_reaches_the_scan(spark, tmp_path):
    prices = spark.read.schema("pig_class string, price double, unit string, week_number int, year int, month_number int, member_state_name string")
    spark.createDataFrame([], "pig_class string, price double, unit string, week_number int, year int, month_number int, member_state_name string").write.parquet(f"{tmp_path}/p")
    text = plan(trade.price_rows(prices.parquet(f"{tmp_path}/p")))
    assert "EqualTo(pig_class,Average S + E)" in text


def test_large_group_extremes_need_no_shuffle_of_the_rows(orders):
    text = plan(scaling.minmax_by(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_totalprice", "o_orderstatus"))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_numbering_of_large_input_has_no_single_task(orders):
    text = plan(ordering.surrogate_ids(orders.select("o_orderkey"), ["o_orderkey"], "i"))
    rows_side = text.split("BroadcastExchange")[0]
    assert "SinglePartition" not in rows_side


def test_small_daily_merge_leaves_the_target_unshuffled(lines):
    keys = ["l_orderkey", "l_linenumber"]
    updates = staging.materialise(lines.select(*keys).where("l_shipdate < '1995-01-10'"))
    text = plan(merge.rows_to_insert(lines.select(*keys), updates, keys))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert "hashpartitioning(l_orderkey" not in text.split("LeftSemi")[1]


def test_range_of_updates_filters_the_target(spark, orders):
    updates = spark.createDataFrame([(1, 5.0)], "o_orderkey bigint, o_totalprice double")
    target = orders.select("o_orderkey", "o_totalprice")
    text = plan(merge.rows_to_insert(target, updates, ["o_orderkey"], range_key="o_orderkey"))
    assert "DataFilters: [" in text and "Subquery" in text


def test_checks_take_one_pass_and_one_per_uniqueness_rule(lines):
    checks = [quality.NotNull("l_orderkey"), quality.Between("l_quantity", 0), quality.NotNull("l_tax")]
    assert plan(quality.run_checks(lines, checks)).count("FileScan") == 1
    unique = [*checks, quality.UniqueTogether(("l_orderkey", "l_linenumber"))]
    assert plan(quality.run_checks(lines, unique)).count("FileScan") == 2


def test_price_cleaning_is_row_local(spark, tmp_path):
    spark.createDataFrame([], cleaning.RAW_PRICES).write.json(f"{tmp_path}/p")
    raw = landing.read_json(spark, f"{tmp_path}/p", cleaning.RAW_PRICES, array=False)
    text = plan(cleaning.clean_prices(raw))
    assert "Exchange" not in text and "Generate" not in text


def test_scalar_extremes_are_read_in_the_plan(orders):
    """Building the query starts no job."""
    spark = orders.sparkSession
    spark.sparkContext.setJobGroup("lazy", "no job expected")
    scaling.winsorised_minmax(orders.select("o_totalprice"), "o_totalprice", "s", lower=0.06, accuracy=100)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("lazy") == []


def test_staging_follows_the_session(spark, monkeypatch, tmp_path):
    root = staging.staging_root(spark)
    assert spark.sparkContext.applicationId in root or "tradewind-" in root
    written = staging.materialise(spark.range(10).select(F.col("id").alias("n")))
    assert "FileScan" in plan(written) and "Range" not in plan(written)


def test_numbering_of_exploded_rows_has_no_single_task(spark):
    """Rows made from few, which a size estimate takes for few."""
    made = spark.range(8).select(F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("n"), F.col("id").alias("m"))
    text = plan(ordering.surrogate_ids(made, ["n", "m"], "i"))
    assert "SinglePartition" not in text.split("BroadcastExchange")[0]
