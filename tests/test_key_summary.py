"""Heavy-hitter summaries: nothing above a slice is missed, and the counts are exact."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from credit_signals.operators import joins as J


def frame(spark, keys, parts=7):
    return spark.createDataFrame([(k,) for k in keys], "k string").repartition(parts)


@pytest.mark.parametrize("counters,together", [(4, 2), (16, 3), (1000, 256)])
def test_bounds(spark, counters, together):
    rng = random.Random(counters)
    keys = [f"k{int(rng.paretovariate(0.7)) % 500}" for _ in range(6000)] + [None] * 50
    df = frame(spark, keys)
    true = Counter(k for k in keys if k)
    names = {r.h: r.k for r in df.where("k is not null").distinct().select("k", F.xxhash64("k").alias("h")).collect()}
    rows = J.key_summary(df, "k", counters, together).collect()
    error = sum(r.n for r in rows if r.h is None)
    kept = {names[r.h]: r.n for r in rows if r.h is not None}
    assert len(kept) <= counters and error <= sum(true.values()) / (counters + 1)
    assert all(kept.get(k, 0) <= n <= kept.get(k, 0) + error for k, n in true.items())


@pytest.mark.parametrize("counters", [2, 40, 16_384])
def test_hot_keys_are_exact(spark, counters):
    rng = random.Random(5)
    keys = [f"k{int(rng.paretovariate(0.9)) % 300}" for _ in range(5000)]
    want = {k: -(-n // 60) for k, n in Counter(keys).items() if n > 60}
    assert {r.k: r.slices for r in J.hot_keys(frame(spark, keys), "k", 60, counters).collect()} == want and len(want) > 3


def test_a_million_rows(spark):
    df = spark.range(0, 1_000_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 5 == 0, F.col("id") % 11)
        .otherwise(F.xxhash64("id") % 400_000).alias("k"))
    got = {r.k: r.slices for r in J.hot_keys(df, "k", 10_000, 128).collect()}
    want = {r.k: -(-r.n // 10_000) for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 10000").collect()}
    assert got == want and len(got) >= 12


def test_no_keys(spark):
    assert J.hot_keys(frame(spark, [None, None]), "k", 1).count() == 0
    assert J.hot_keys(frame(spark, ["a"]).limit(0), "k", 1).count() == 0
