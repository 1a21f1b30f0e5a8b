"""Quantiles from stored sketches, and unique keys that are large."""

import bisect
import random

from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import quality, scaling, sketches

SCHEMA = "day string, g string, v double"


def store(spark, path):
    return sketches.SketchStore(spark, str(path), "g string", k=200)


def test_merged_days_are_near_the_exact_ranks(spark, tmp_path):
    pick = random.Random(4)
    data = [(f"d{i % 5}", pick.choice("ab"), pick.lognormvariate(0, 2)) for i in range(20_000)]
    held = store(spark, tmp_path)
    for day in ("d0", "d1", "d2", "d3", "d4"):
        frame = spark.createDataFrame([t for t in data if t[0] == day], SCHEMA)
        for _ in range(2 if day == "d1" else 1):  # a repeated day counts once
            held.add(frame, F.col("day"), "v")
    probs = {"q06": 0.06, "q50": 0.5, "q98": 0.98, "least": 0.0, "most": 1.0}
    for r in sketches.quantiles_of(held.merged(), probs).collect():
        values = sorted(v for _, g, v in data if g == r.g)
        assert r.n == len(values) and (r.least, r.most) == (values[0], values[-1])
        for name, p in list(probs.items())[:3]:
            assert abs(bisect.bisect_right(values, r[name]) / len(values) - p) < 0.025
    one = held.merged({"d3"})
    assert {r.g: r.n for r in one.collect()} == {g: sum(t[:2] == ("d3", g) for t in data) for g in "ab"}


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    held = store(spark, tmp_path)
    held.add(spark.createDataFrame([("x", "a", 1.0), ("y", "a", 2.0)], SCHEMA), F.col("day"), "v")
    assert all("part=x" in f for f in held.table.read(parts={"x"}).inputFiles())


def test_odd_values_and_empty_groups(spark, tmp_path):
    held = store(spark, tmp_path)
    data = [("x", "a", float("nan")), ("x", "a", None), ("x", "b", 1.0), (None, "b", 3.0), ("y", None, 2.0)]
    held.add(spark.createDataFrame(data, SCHEMA), F.col("day"), "v")
    held.add(spark.createDataFrame([], SCHEMA), F.col("day"), "v")
    got = sketches.quantiles_of(held.merged(), {"low": 0.0, "high": 1.0})
    assert rows(got) == [("b", 2, 1.0, 3.0), (None, 1, 2.0, 2.0)]
    assert rows(sketches.limits_of(held.merged())) == [(1.0, 3.0)]
    nothing = store(spark, tmp_path / "none").merged()
    assert rows(sketches.limits_of(nothing, 0.1, 0.9)) == [(None, None)]
    raw = sketches.value_sketches(spark.createDataFrame(data, SCHEMA), ["g"], "v")
    assert {r.g: r.q for r in sketches.quantiles_of(raw, {"q": 0.5}).collect()}["a"] is None


def test_winsorising_with_stored_limits(spark, tmp_path):
    frame = spark.createDataFrame([("x", "a", float(v)) for v in range(101)], SCHEMA)
    held = store(spark, tmp_path)
    held.add(frame, F.col("day"), "v")
    got = scaling.winsorised_minmax(frame, "v", "s", given=sketches.limits_of(held.merged(), upper=0.98))
    exact = scaling.winsorised_minmax(frame, "v", "s", upper=0.98)
    for a, b in zip(rows(got), rows(exact)):
        assert abs(a[-1] - b[-1]) < 0.03


def test_wide_keys_count_as_narrow_ones(spark):
    data = [("a" * 100, 1), ("a" * 100, 1), ("a" * 100, None), (None, None), (None, None), (None, 2), (None, 2), ("b", 3)]
    frame = spark.createDataFrame(data, "t string, n int")
    for keys in (("t", "n"), ("t",), ("n",)):
        assert rows(quality.repeated_rows(frame, keys, wide=True)) == rows(quality.repeated_rows(frame, keys))


def test_wide_keys_are_shuffled_as_hashes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = quality.repeated_rows(docs, ("source", "text"), wide=True)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in text.splitlines() if "Exchange hashpartitioning(__hash" in line]
    assert first and "LeftSemi" in text
