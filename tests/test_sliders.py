"""Partners that are ever among the best, against the whole grid."""

import itertools

import numpy as np
import pytest

from tradewind.operators.sliders import ever_in_top


def grid(values, n, steps):
    """Who is among the n best, ties included, at any setting; the score written out."""
    def both(a, b, share):
        out = np.where(np.isnan(a), 0, share * a) + np.where(np.isnan(b), 0, (1 - share) * b)
        return np.where(np.isnan(a) & np.isnan(b), np.nan, out)

    size, gap, cagr, gdp, tariff, dist = values.T
    base = np.where(np.isnan(tariff) | np.isnan(dist), 0.5, 1.0)
    ever = set()
    for wd, wt, wf, wc, ws in itertools.product(np.arange(steps + 1) / steps, repeat=5):
        demand = both(both(size, gap, ws), both(cagr, gdp, wc), wt)
        score = np.round(both(demand, base - both(tariff, dist, wf), wd), 4)
        known = np.sort(score[~np.isnan(score)])[::-1]
        if len(known):
            ever |= set(np.flatnonzero(score >= known[min(n, len(known)) - 1]).tolist())
    return ever


@pytest.mark.parametrize("seed,n,steps,blank", [(1, 2, 5, 0.0), (2, 3, 4, 0.2), (3, 1, 1, 0.3)])
def test_ever_in_top_is_the_whole_grid(spark, seed, n, steps, blank):
    rng = np.random.default_rng(seed)
    values = rng.random((18, 6)) * rng.uniform(0.3, 1, (18, 1))
    values[rng.random(values.shape) < blank] = np.nan
    values[0], values[1] = np.nan, values[2]
    rows = [(i, f"c{i}", *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(values)]
    ddl = "country_id int, name string, size_n double, gap_n double, cagr_n double, gdp_n double, tariff_n double, dist_n double"
    got = ever_in_top(spark.createDataFrame(rows, ddl), n, steps).collect()
    assert {r.country_id for r in got} == grid(values, n, steps) and len(got) == len({r.country_id for r in got})


def test_ever_in_top_of_nothing(spark):
    ddl = "country_id int, name string, size_n double, gap_n double, cagr_n double, gdp_n double, tariff_n double, dist_n double"
    assert ever_in_top(spark.createDataFrame([], ddl)).count() == 0
    one = spark.createDataFrame([(1, "a", None, None, None, None, 0.2, None)], ddl)
    assert [tuple(r) for r in ever_in_top(one, steps=3).collect()] == [(1, "a")]
