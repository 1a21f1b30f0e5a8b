import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind.operators import ordering, scaling
from tradewind.operators.bucketing import biggest_or_other
from tradewind.operators.growth import windowed_cagr


def test_minmax_by_group(spark):
    df = spark.createDataFrame(
        [(2020, -5.0), (2020, 5.0), (2020, None), (2021, 3.0), (2022, 4.0), (2022, 4.0), (None, 1.0), (None, 3.0)],
        "year int, v double",
    )
    out = scaling.minmax_by(df, "v", "year")
    assert out.columns == ["year", "v", "v_normalized"]
    assert rows(out) == rows(
        spark.createDataFrame(
            [
                (2020, -5.0, 0.0), (2020, 5.0, 1.0), (2020, None, None), (2021, 3.0, None),
                (2022, 4.0, None), (2022, 4.0, None), (None, 1.0, 0.0), (None, 3.0, 1.0),
            ],
            "a int, b double, c double",
        )
    )


def test_minmax_by_large_path_is_the_same(spark):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.uniform(-9, 9), rng.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(data, "g int, a double, b int")
    got = scaling.minmax_by(df, {"a": "x", "b": "y"}, "g").collect()
    for r in got:
        part = [d for d in data if d[0] == r["g"]]
        low, high = min(p[1] for p in part), max(p[1] for p in part)
        assert r["x"] == pytest.approx((r["a"] - low) / (high - low))
    assert len(got) == 300


def test_minmax_overall(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert rows(scaling.minmax_overall(df, {"v": "n"})) == [(1.0, 0.0), (3.0, 1.0), (None, None)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert rows(scaling.minmax_overall(same, "v")) == [(2.0, None)] * 2
    assert scaling.minmax_overall(df.limit(0), "v").collect() == []


@pytest.mark.parametrize("n", [1, 10, 150])
def test_winsorise(spark, n):
    values = [float(v) for v in random.Random(n).sample(range(1000), n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    low = sorted(values)[max(math.ceil(0.06 * n), 1) - 1]
    high = sorted(values)[math.ceil(0.98 * n) - 1]
    got = scaling.winsorise(df, "v", "w", lower=0.06, upper=0.98)
    for v, w in got.collect():
        assert w == (None if v is None else min(max(v, low), high))


def test_winsorise_empty_and_sketch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    assert scaling.winsorised_minmax(df.limit(0), "v", "n", lower=0.06).collect() == []
    got = scaling.winsorise(df, "v", "w", lower=0.06, accuracy=10000)
    assert got.agg(F.min("w")).first()[0] == 5.0
    scaled = scaling.winsorised_minmax(df, "v", "n", lower=0.06)
    assert scaled.columns == ["v", "n"]
    assert scaled.agg(F.min("n"), F.max("n")).first()[:] == (0.0, 1.0)


def test_quantiles_are_exact(spark):
    rng = random.Random(3)
    values = [rng.choice([7.0] * 400 + list(range(300))) * 1.0 for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double").repartition(5)
    probs = {"a": 0.01, "b": 0.06, "c": 0.5, "d": 0.98, "e": 1.0}
    want = [sorted(values)[max(math.ceil(p * len(values)), 1) - 1] for p in probs.values()]
    assert list(ordering.exact_quantiles(df, "v", probs).first()) == want
    empty = ordering.exact_quantiles(df.where("v < -1"), "v", probs).first()
    assert list(empty) == [None] * 5


def test_surrogate_ids_large_path(spark):
    names = [f"{i % 3}-{i:05d}" for i in range(5000)]
    df = spark.createDataFrame([(n,) for n in names], "n string").repartition(7)
    got = dict((r["n"], r["i"]) for r in ordering.surrogate_ids(df, ["n"], "i").collect())
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_top_with_ties(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([5.0, 4.0, 4.0, 4.0, 1.0, None])], "i int, s double")
    assert rows(ordering.top_with_ties(df, "s", 2).select("i")) == [(0,), (1,), (2,), (3,)]
    assert ordering.top_with_ties(df, "s", 12).count() == 5
    years = spark.createDataFrame([(y,) for y in [2020, 2020, 2019, 2018, None]], "year int")
    assert rows(ordering.latest_years(years, 2)) == [(2019,), (2020,), (2020,)]


def cagr_of(spark, values, **kw):
    df = spark.createDataFrame([(1, y, v) for y, v in values], "country_id int, year int, import_tonnes double")
    got = windowed_cagr(df, "import_tonnes", **kw).collect()
    return got[0] if got else None


def test_cagr_windows(spark):
    full = [(2015 + i, 2.0**i) for i in range(9)]  # 2015 to 2023
    r = cagr_of(spark, full)
    assert (r["first_year"], r["last_year"], r["n_periods_non_null"]) == (2018, 2023, 6)
    assert r["import_CAGR"] == pytest.approx(1.0)
    assert cagr_of(spark, full[:4]) is None  # ends before the earliest year
    assert cagr_of(spark, [(2020 + i, 1.0) for i in range(4)]) is None
    five = cagr_of(spark, [(2017 + i, 1.0 + i) for i in range(5)])
    assert five["import_CAGR"] == pytest.approx(5 ** (1 / 4) - 1)
    assert cagr_of(spark, [(2018, 0.0)] + full[4:])["import_CAGR"] is None
    assert cagr_of(spark, [(2018, None)] + full[4:])["import_CAGR"] is None
    assert cagr_of(spark, [(2020, 1.0)]) is None
    assert cagr_of(spark, [(2020, 1.0)], min_periods=1)["import_CAGR"] is None


def test_cagr_of_repeated_rows(spark):
    """Many copies of one year give one year."""
    many = [(2018, 1.0)] * 50 + [(2019 + i, 2.0 ** (i + 1)) for i in range(5)]
    r = cagr_of(spark, many)
    assert r["import_CAGR"] == pytest.approx(1.0)
    assert r["n_periods_non_null"] == 55


def test_biggest_or_other(spark):
    data = [("a", 9.0, 1), ("b", 8.0, 1), ("c", 8.0, 1), ("d", 1.0, 1), ("e", None, 1), ("f", 99.0, 0)]
    df = spark.createDataFrame(data, "s string, t double, y int")
    got = dict(map(tuple, biggest_or_other(df, "s", "t", 2, F.col("y") == 1).collect()))
    assert got == {"a": "a", "b": "b", "c": "c", "d": "Other", "e": "Other"}
    few = dict(map(tuple, biggest_or_other(df, "s", "t", 7).collect()))
    assert few == {k: k for k in "abcdef"}


def test_nan_does_not_blank_a_scale(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 1), (float("nan"), 1), (float("inf"), 1)], "v double, g int")
    want = [(1.0, 0.0), (3.0, 1.0)]
    for got in (scaling.minmax_overall(df, {"v": "n"}), scaling.minmax_by(df, {"v": "n"}, "g")):
        assert rows(got.where("v < 10").select("v", "n")) == want
        assert [r[0] for r in got.where("NOT v < 10").select("n").collect()] == [None, None]
