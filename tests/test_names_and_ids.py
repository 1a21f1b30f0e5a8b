"""Ids that stay, names nearly right, the best of every group, grouping sets."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import lookup, ordering, scoring
from tradewind.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_stay_when_keys_come_and_go(spark, database):
    name, ddl = f"{database}.ids", "iso3 string, country_id int"

    def load(*codes):
        frame = spark.createDataFrame([(c,) for c in codes], "iso3 string")
        return rows(tables.refresh_ids(frame, name, ddl, ["iso3"], "country_id"))

    assert load() == []
    assert load("DEU", "POL", "POL", None) == [("DEU", 1), ("POL", 2)]
    assert load("AUT", "POL", "CHN") == [("AUT", 3), ("CHN", 4), ("DEU", 1), ("POL", 2)]
    assert load("DEU") == load("AUT")


def test_near_names_by_brute_force(spark):
    names = ["poland", "POLND", " Polamd ", "Ploand", "Germny", "", "x", None, "Iran", "Irak", "Ira", "Polannd"]
    aliases = [("Poland", "POL"), ("Germany", "DEU"), ("Iran", "IRN"), ("Iraq", "IRQ"), (None, "NUL"), ("Pologne", "POL"), ("X", None)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    frame = spark.createDataFrame([(n, 1) for n in names] * 3, "country string, __name int")
    known = spark.createDataFrame(aliases, "alias string, iso3 string")
    for edits in (1, 2):
        want = []
        for n in {n for n in names if n is not None}:
            found = [(distance(n.strip().lower(), a.lower()), c) for a, c in aliases if a and c]
            least = min(d for d, _ in found)
            codes = {c for d, c in found if d == least}
            if least > edits:
                want.append((n, None, None))
            else:
                want.append((n, codes.pop() if len(codes) == 1 else None, least))
        got = lookup.near_names(frame, known, "country", edits=edits)
        assert rows(got) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
        assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)
    with pytest.raises(ValueError):
        lookup.near_names(frame, known, "country", edits=3)


def test_best_of_groups_keeps_ties_and_null_groups(spark):
    data = [("a", v) for v in (5.0, 5.0, 4.0, 4.0, 4.0, 1.0, None)] + [(None, 1.0), (None, 2.0), (None, 2.0), ("b", None)]
    frame = spark.createDataFrame(data, "g string, v double")
    assert rows(ordering.top_with_ties_by(frame, ["g"], "v", 3)) == [
        ("a", 4.0), ("a", 4.0), ("a", 4.0), ("a", 5.0), ("a", 5.0), (None, 1.0), (None, 2.0), (None, 2.0)
    ]
    assert ordering.top_with_ties_by(frame.limit(0), ["g"], "v", 3).count() == 0


def test_a_group_is_cut_before_it_is_shuffled(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    text = plan(ordering.top_with_ties_by(lines.select("l_returnflag", "l_tax"), ["l_returnflag"], "l_tax", 12))
    assert "WindowGroupLimit [l_returnflag" in text and ", Partial" in text


def test_four_grouping_sets(spark):
    broken = spark.createDataFrame(
        [(1, "s", "Demand", "Trade", "Import size", 0.5)],
        "country_id int, scenario string, level1 string, level2 string, parameter string, weighted_value double",
    )
    weights = scoring.with_scenarios(broken.select("country_id"), [scoring.Weights(scenario="s")])
    got = scoring.weight_rollup(broken, weights, ["country_id", "scenario"])
    assert sorted(r.depth for r in got.collect()) == [0, 1, 2, 3]
    text = got._jdf.queryExecution().optimizedPlan().toString()
    expand = next(line for line in text.splitlines() if "Expand" in line)
    assert all(f", {level})" in expand or f", {level}]" in expand for level in (0, 1, 3, 7))
    assert not any(f", {level}]" in expand for level in (15, 31, 63))
