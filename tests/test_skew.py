"""The hot-key left join equals the plain left join, whatever is hot."""

import pytest
from pyspark.sql import functions as F

from credit_signals.operators.joins import hot_keys, left_join, split_left_join


def _pair(spark):
    left = spark.createDataFrame(
        [("h", 1), ("h", 2), ("h", 3), ("a", 4), ("b", 5), (None, 6), ("z", 7)], "k string, lv int")
    right = spark.createDataFrame(
        [("h", 10)] * 40 + [("h", 11)] * 10 + [("a", 20), ("a", 21), ("b", 30), (None, 99), ("y", 40)],
        "k string, rv int")
    return left, right


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_equals_plain_with_exact_copies(spark):
    left, right = _pair(spark)
    plain = left.join(right, "k", "left")
    salted = split_left_join(left, right, "k", [("h", 1, 7), ("a", 1, 2)])
    assert salted.columns == plain.columns == ["k", "lv", "rv"]
    assert _same(salted, plain)
    assert salted.count() == 3 * 50 + 2 + 1 + 1 + 1


def test_hot_keys_are_those_above_a_slice_and_never_null(spark):
    _, right = _pair(spark)
    assert {r.k: r.slices for r in hot_keys(right, "k", slice_rows=1).collect()} == {"h": 50, "a": 2}
    many = spark.range(6000).selectExpr("concat('k', id % 2000) as k")          # no floor on their number
    assert hot_keys(many, "k", slice_rows=2).count() == 2000


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for a large right side
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("slice_rows", [1, 3, 1000])
def test_left_join_matches_plain(spark, no_broadcast, slice_rows):
    left, right = _pair(spark)
    got = left_join(left, right, "k", slice_rows=slice_rows)
    salted = "Generate" in got._jdf.queryExecution().executedPlan().toString()
    assert salted == (slice_rows < 50)          # 'h' has 50 right rows, 3 left rows
    assert _same(got, left.join(right, "k", "left"))


def test_small_right_side_skips_detection(spark):
    from credit_signals.session import scratch_path
    left, right = _pair(spark)
    path = scratch_path(spark, "t-small-right")
    right.write.parquet(path)
    right = spark.read.parquet(path)            # a file scan has a size estimate
    got = left_join(left, right, "k", slice_rows=1)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert _same(got, left.join(right, "k", "left"))


def test_hot_right_rows_are_spread_over_slices(spark):
    left, right = _pair(spark)
    salted = split_left_join(left, right.repartition(4), "k", [("h", 1, 5)])
    assert salted.where(F.col("k") == "h").count() == 150
    parts = (salted.where(F.col("k") == "h").groupBy("lv", "rv").count().collect())
    assert {(r.lv, r.rv): r["count"] for r in parts}[(1, 10)] == 40


def test_copies_are_chunked_deterministically(spark):
    left, right = _pair(spark)
    a = split_left_join(left, right, "k", [("h", 2, 5)])
    b = split_left_join(left, right.repartition(3), "k", [("h", 2, 5)])
    assert _same(a, b) and _same(a, left.join(right, "k", "left"))


def _grid_pair(spark):
    # 'L' hot on the left only (40 copies + 5 distinct, 2 right rows), 'M' hot on the left with no right row,
    # 'B' hot on both sides, 'R' hot on the right only, plus cold keys and NULL keys on both sides.
    left = (
        [("L", 1)] * 40 + [("L", i) for i in range(2, 7)] + [("M", 9)] * 12 + [("B", 3)] * 6 + [("B", 4)] * 4
        + [("R", 5), ("c", 6), (None, 7), ("d", 8)])
    right = (
        [("L", 100), ("L", 101)] + [("B", 200)] * 7 + [("B", 201)] * 3 + [("R", 300)] * 15 + [("R", 301)]
        + [("c", 400), ("c", 401), (None, 500), ("e", 600)])
    return (spark.createDataFrame(left, "k string, lv int"), spark.createDataFrame(right, "k string, rv int"))


@pytest.mark.parametrize("slice_rows", [1, 2, 5, 100])
def test_grid_join_equals_plain_on_both_sides(spark, no_broadcast, slice_rows):
    left, right = _grid_pair(spark)
    plain = left.join(right, "k", "left")
    got = left_join(left, right, "k", slice_rows=slice_rows)
    assert got.columns == plain.columns
    assert _same(got, plain)


def test_explicit_grid_with_left_only_and_unmatched_hot_keys(spark):
    left, right = _grid_pair(spark)
    got = split_left_join(left, right, "k", [("L", 3, 1), ("M", 4, 1), ("B", 2, 3), ("R", 1, 4)])
    plain = left.join(right, "k", "left")
    assert _same(got, plain)
    assert got.where((F.col("k") == "M") & F.col("rv").isNull()).count() == 12


def test_cold_branch_keeps_bucketed_join(spark, no_broadcast):
    import re

    from paths import SF001
    from credit_signals.sources import fixtures as fx
    a, b = fx.accounts(spark, SF001), fx.bureau(spark, SF001)
    got = split_left_join(a, b, "account_id", [("A000000001", 2, 2)])
    assert _same(got, a.join(b, "account_id", "left"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    cold = plan.split("Union", 1)[1].split("hot-rows", 1)[0]
    assert re.findall(r"Bucketed: (\w+)", cold)[:2] == ["true", "true"]
    shuffled = [x for x in plan.splitlines() if "Exchange hashpartitioning(account_id" in x]
    assert "SortMergeJoin" in cold and not shuffled                    # co-bucketed, no shuffle of the cold rows


def test_long_keys(spark, no_broadcast):
    left = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (None, "n")], "k long, lv string")
    right = spark.createDataFrame([(1, "x")] * 6 + [(3, "y")], "k long, rv string")
    got = left_join(left, right, "k", slice_rows=2)
    assert _same(got, left.join(right, "k", "left"))


def test_copies_spread_over_the_slices(spark):
    from credit_signals.operators.joins import _sliced
    right = spark.createDataFrame([("h", 10)] * 400, "k string, rv int")
    hot = spark.createDataFrame([("h", 1, 4)], "k string, ls int, rs int")
    rows = _sliced(right, "k", hot, "rs", True)
    first = sorted((r.at, r["count"]) for r in rows.groupBy("at").count().collect())
    assert sum(n for _, n in first) == 400 and len(first) == 4 and min(n for _, n in first) > 60
    assert first == sorted((r.at, r["count"]) for r in rows.repartition(3).groupBy("at").count().collect())


def test_columns_pass_through_as_they_are(spark, no_broadcast):
    left = spark.createDataFrame([("h", 1, {"a": 1}, -0.0)] * 3 + [("h", 2, {}, 0.0), (None, 3, None, None)],
                                 "k string, v int, m map<string,int>, z double")
    right = spark.createDataFrame([("h", 7, 0.5)] * 3 + [("c", 8, None)], "k string, v int, x double")
    got = left_join(left, right, "k", slice_rows=2)
    plain = left.join(right, "k", "left")
    assert got.columns == plain.columns == ["k", "v", "m", "z", "v", "x"]                  # equal names stay
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))          # -0.0 and maps too
    assert repr(got.collect()).count("-0.0") == 9


def test_collated_keys(spark, no_broadcast):
    left = spark.sql("select k collate UTF8_LCASE as k, v from values ('Foo', 1), ('FOO', 2), ('foo', 3), ('bar', 4) t(k, v)")
    right = spark.sql("select k collate UTF8_LCASE as k, w from values ('fOO', 10), ('FOo', 11), ('Baz', 12) t(k, w)")
    got = left_join(left, right, "k", slice_rows=1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, left.join(right, "k", "left").collect()), key=repr)


def test_fifty_thousand_by_fifty_thousand_copies(spark, no_broadcast):
    left = spark.range(50_000).select(F.lit("h").alias("k"), F.lit(1).alias("v"))
    right = spark.range(50_000).select(F.lit("h").alias("k"), F.lit(2).alias("w"))
    got = left_join(left, right, "k", slice_rows=5_000).limit(1_000)
    assert got.count() == 1_000
    exact = left_join(left.limit(600), right.limit(700), "k", slice_rows=100)
    assert exact.count() == 420_000


def test_null_keys_stay_out_of_the_join(spark, no_broadcast):
    left, right = _pair(spark)
    plan = left_join(left, right, "k", slice_rows=1000)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "isnull(k" in plan
