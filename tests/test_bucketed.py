"""Merges into bucketed tables."""

import re

from conftest import rows
from tradewind.operators.merge import rows_to_insert
from tradewind.sources import tables

DDL = "k bigint, n int, v double"


def test_a_bucketed_target_is_not_shuffled(spark, database):
    name, buckets = f"{database}.t", tables.Buckets(8, ("k", "n"))
    first = spark.range(1000).selectExpr("id AS k", "CAST(id % 7 AS INT) AS n", "1.0D AS v")
    second = spark.range(500, 1500).selectExpr("id AS k", "CAST(id % 7 AS INT) AS n", "2.0D AS v")
    for load in (first, second, second):
        tables.merge_new_rows(load, name, DDL, ["k", "n"], buckets=buckets)
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert len(got) == 1500 == spark.table(name).count()
    assert {k for k, v in got.items() if v == 2.0} == set(range(1000, 1500))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = rows_to_insert(spark.table(name), second, ["k", "n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Bucketed: true" in text and "CartesianProduct" not in text
    # No line between the scan of the table and the joins over it is an exchange.
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(re.match(r"[^A-Za-z]*", lines[scan])[0])
    above = []
    for line in reversed(lines[:scan]):
        here = len(re.match(r"[^A-Za-z]*", line)[0])
        if here < depth:
            above.append(line)
            depth = here
    assert above and not any("Exchange" in line for line in above), above


def test_null_keys_are_always_added(spark, database):
    name, buckets = f"{database}.t", tables.Buckets(4, ("k", "n"))
    frame = spark.createDataFrame([(1, 1, 1.0), (None, 1, 2.0)], DDL)
    for _ in range(2):
        tables.merge_new_rows(frame, name, DDL, ["k", "n"], buckets=buckets)
    assert rows(spark.table(name)) == [(1, 1, 1.0), (None, 1, 2.0), (None, 1, 2.0)]
