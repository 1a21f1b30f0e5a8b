"""Random inputs against plain Python."""

import math

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradewind.operators import merge, scaling

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
numbers = st.one_of(st.none(), st.integers(-50, 50).map(float))


@FEW
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), numbers), min_size=1, max_size=40))
def test_scaled_values_lie_between_zero_and_one(spark, data):
    df = spark.createDataFrame(data, "g int, v double")
    for g, v, n in scaling.minmax_by(df, "v", "g").collect():
        known = [x for k, x in data if k == g and x is not None]
        if v is None or len(set(known)) < 2:
            assert n is None
        else:
            assert math.isclose(n, (v - min(known)) / (max(known) - min(known)))


@FEW
@given(st.lists(numbers, min_size=1, max_size=60), st.sampled_from([0.01, 0.06, 0.5]))
def test_winsorised_values(spark, values, share):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    for v, w in scaling.winsorise(df, "v", "w", lower=share).collect():
        low = known[max(math.ceil(share * len(known)), 1) - 1] if known else None
        assert w == (None if v is None else max(v, low))


keyed = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), numbers), max_size=15
)


@FEW
@given(keyed, st.dictionaries(st.integers(0, 6), numbers, max_size=6))
def test_upsert_against_a_dictionary(spark, target, source):
    ddl = "k int, v double"
    t = spark.createDataFrame(target, ddl)
    s = spark.createDataFrame(list(source.items()), ddl)
    want = [(k, source.get(k, v)) for k, v in target]
    want += [(k, v) for k, v in source.items() if k not in {k for k, _ in target}]
    order = lambda x: [(v is None, str(v)) for v in x]
    once = merge.upsert(t, s, ["k"], ["v"], unique_source=True)
    got = rows(once)
    assert got == sorted(want, key=order) or sorted(map(str, got)) == sorted(map(str, want))
    again = rows(merge.upsert(once, s, ["k"], ["v"]))
    assert sorted(map(str, again)) == sorted(map(str, want))
