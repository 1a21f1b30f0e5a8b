import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind.operators import merge
from tradewind.sources import tables

DDL = "k int, g string, v double"


def table(spark, data):
    return spark.createDataFrame(data, DDL)


@pytest.fixture(params=["broadcast", "shuffled"])
def join_kind(request, spark):
    """Run once with small sides broadcast and once with every join shuffled."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    if request.param == "shuffled":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, old)


def test_insert_only(spark, join_kind):
    target = table(spark, [(1, "a", 1.0), (2, "a", 2.0), (None, "a", 3.0)])
    updates = table(
        spark,
        [(1, "a", 9.0), (1, "b", 4.0), (3, "a", 5.0), (3, "a", 6.0), (None, "a", 7.0), (1, None, 8.0)],
    )
    got = merge.insert_only_merge(target, updates, ["k", "g"])
    assert rows(got) == rows(
        table(
            spark,
            [
                (1, "a", 1.0), (2, "a", 2.0), (None, "a", 3.0), (1, "b", 4.0), (3, "a", 5.0),
                (3, "a", 6.0), (None, "a", 7.0), (1, None, 8.0),
            ],
        )
    )
    again = merge.rows_to_insert(got, updates, ["k", "g"])
    assert rows(again) == rows(table(spark, [(None, "a", 7.0), (1, None, 8.0)]))


def test_insert_only_with_range(spark):
    target = table(spark, [(k, "a", 0.0) for k in range(100)])
    updates = table(spark, [(98, "a", 1.0), (100, "a", 1.0), (None, "a", 1.0)])
    got = merge.rows_to_insert(target, updates, ["k", "g"], range_key="k")
    assert rows(got) == [(100, "a", 1.0), (None, "a", 1.0)]


def test_upsert(spark, join_kind):
    target = table(spark, [(1, "a", 1.0), (2, "a", 2.0), (3, "a", 3.0), (None, "a", 4.0)])
    source = table(spark, [(1, "a", None), (3, "a", 30.0), (4, "a", 40.0), (None, "a", 50.0)])
    want = rows(
        table(
            spark,
            [(1, "a", None), (2, "a", 2.0), (3, "a", 30.0), (4, "a", 40.0), (None, "a", 4.0), (None, "a", 50.0)],
        )
    )
    for unique in (True, False):
        assert rows(merge.upsert(target, source, ["k", "g"], ["v"], unique)) == want


def test_upsert_with_duplicates(spark, join_kind):
    target = table(spark, [(1, "a", 1.0), (1, "a", 1.5)])
    source = table(spark, [(1, "a", 8.0), (1, "a", 7.0), (2, "a", 3.0), (2, "a", 3.0)])
    got = merge.upsert(target, source, ["k", "g"], ["v"])
    assert rows(got) == [(1, "a", 7.0), (1, "a", 7.0), (2, "a", 3.0), (2, "a", 3.0)]
    latest = merge.upsert(target, source, ["k", "g"], ["v"], prefer=[-F.col("v")])
    assert (1, "a", 8.0) in rows(latest)
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert(target, source, ["k", "g"], ["v"], on_duplicate="error").collect()
    # Duplicates that match nothing are no error.
    free = table(spark, [(5, "a", 1.0)])
    assert merge.upsert(free, source, ["k", "g"], ["v"], on_duplicate="error").count() == 5


def test_insert_missing(spark):
    target = table(spark, [(1, "a", 1.0)])
    source = table(spark, [(1, "a", 2.0), (2, "a", 3.0), (2, "a", 3.0)])
    assert rows(merge.insert_missing(target, source, ["k", "g"])) == [(1, "a", 1.0), (2, "a", 3.0)]


def test_hot_key_against_brute_force(spark, join_kind):
    """A third of the updates share one key, another part has none."""
    target = spark.range(0, 500).select((F.col("id") * 2).cast("int").alias("k"), F.lit("a").alias("g"), F.lit(0.0).alias("v"))
    updates = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 0, F.col("id") % 1500).cast("int").alias("k"),
        F.lit("a").alias("g"),
        F.col("id").cast("double").alias("v"),
    )
    have = {r["k"] for r in target.collect()}
    want = sorted(r["v"] for r in updates.collect() if r["k"] is None or r["k"] not in have)
    got = merge.rows_to_insert(target, updates, ["k", "g"])
    assert sorted(r["v"] for r in got.collect()) == want


def test_tables(spark, database):
    name = f"{database}.t"
    assert tables.create_if_missing(spark, name, DDL)
    assert not tables.create_if_missing(spark, name, DDL)
    updates = spark.createDataFrame([("1", "a", "1.5"), ("x", "a", "2")], "k string, g string, v string")
    tables.merge_new_rows(updates, name, DDL, ["k", "g"])
    assert rows(spark.table(name)) == [(1, "a", 1.5), (None, "a", 2.0)]
    tables.merge_new_rows(updates.where("k = '1'"), name, DDL, ["k", "g"])
    assert spark.table(name).count() == 2
    more = table(spark, [(1, "a", 9.0), (2, "b", 3.0)])
    for _ in range(2):
        tables.upsert_table(more, name, DDL, ["k", "g"], ["v"])
        assert rows(spark.table(name)) == [(1, "a", 9.0), (2, "b", 3.0), (None, "a", 2.0)]
    tables.append_table(more, name, DDL)
    assert spark.table(name).count() == 5
    tables.overwrite_table(more, name, DDL)
    assert spark.table(name).count() == 2


def test_partitioned_upsert(spark, database):
    name = f"{database}.p"
    first = table(spark, [(1, "a", 1.0), (2, "a", 2.0), (1, "b", 3.0)])
    tables.upsert_table(first, name, DDL, ["k", "g"], ["v"], partition_by="g")
    files = set(spark.table(name).where("g = 'b'").inputFiles())
    second = table(spark, [(1, "a", 10.0), (3, "a", 30.0), (9, "c", 9.0), (5, None, 5.0)])
    tables.upsert_table(second, name, DDL, ["k", "g"], ["v"], partition_by="g")
    got = rows(spark.table(name).select("k", "g", "v"))
    assert got == [
        (1, "a", 10.0), (1, "b", 3.0), (2, "a", 2.0), (3, "a", 30.0), (5, None, 5.0), (9, "c", 9.0),
    ]
    assert set(spark.table(name).where("g = 'b'").inputFiles()) == files  # left untouched
