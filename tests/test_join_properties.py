"""Property: the hot-key left join equals the plain left join on any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credit_signals.operators.joins import left_join, split_left_join

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 3)), max_size=40)


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=ROWS, right=ROWS, slice_rows=st.integers(1, 6))
def test_detected_split_equals_plain(spark, left, right, slice_rows):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        l_df = spark.createDataFrame(left, "k string, lv int")
        r_df = spark.createDataFrame(right, "k string, rv int")
        got = left_join(l_df, r_df, "k", slice_rows=slice_rows)
        assert _same(got, l_df.join(r_df, "k", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=ROWS, right=ROWS, slice_rows=st.integers(1, 4),
       grid=st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                            st.tuples(st.integers(1, 3), st.integers(1, 3)), max_size=4))
def test_any_grid_equals_plain(spark, left, right, slice_rows, grid):
    """Any grid is exact as long as a right-split key has right rows."""
    right_keys = {k for k, _ in right}
    hot = [(k, ls, rs if k in right_keys else 1) for k, (ls, rs) in grid.items()]
    l_df = spark.createDataFrame(left, "k string, lv int")
    r_df = spark.createDataFrame(right, "k string, rv int")
    if not hot:
        return
    got = split_left_join(l_df, r_df, "k", hot)
    assert _same(got, l_df.join(r_df, "k", "left"))
