"""Warehouse contract, splits, AUC, run rules and empty inputs outside the oracle's range."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals import schemas
from credit_signals.operators import model as M
from credit_signals.operators import runs as RN
from credit_signals.plans import jobs
from credit_signals.session import checkpoint_dir, scratch_path
from credit_signals.sinks import writers as W
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD
from credit_signals.streaming.features import start_feature_stream


def test_wide_keys_keep_all_digits(spark):
    keys = [42, 999_999_999, 100_000_000, 1_000_000_000, 1_000_000_007, 12_345_678_901_234]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", fx.account_key().alias("account_id"))
    got = rows.withColumn("back", fx.key_number()).collect()
    assert all(r.back == r.k for r in got) and len({r.account_id for r in got}) == len(keys)
    assert got[0].account_id == "A000000042"


def test_sums_of_a_huge_customer_do_not_overflow(spark):
    profile = spark.createDataFrame([(1, 1e18, 9 * 10**18, 8 * 10**18, 10**18, *([10**10] * 8), dt.datetime(2001, 1, 1))],
                                    "k long, c_acctbal double, tot long, f long, p long, n long, u long, inq long, d30 long, "
                                    "d60 long, d90 long, t90 long, coll long, first_order timestamp_ntz")
    a, b = fx.accounts_from_profile(profile).first(), fx.bureau_from_profile(profile).first()
    assert a.monthly_income == a.balance == a.open_credit_lines == 2**31 - 1 and 0.8 < a.debt_ratio < 0.9
    assert 0.1 < b.revolving_utilization < 0.12
    assert fx.bucket_count(10**12) == fx.MAX_BUCKETS


def test_both_halves_of_a_split_hold_every_row(spark):
    rows = spark.createDataFrame([(None,), (None,), ("A000000001",), ("A000000002",), ("A000000003",)], "account_id string")
    for split, label in ((M.hash_split, M.split_label()), (M.random_split, M.random_split_label())):
        train, test = split(rows)
        assert train.count() + test.count() == 5
        sizes = {r.s: r["count"] for r in rows.groupBy(label.alias("s")).count().collect()}
        assert sizes == {k: n for k, n in (("train", train.count()), ("test", test.count())) if n}


def test_auc_counts_of_ten_billion_rows(spark):
    cells = spark.createDataFrame([(1, 10**10, 9 * 10**10, 0), (2, 3 * 10**10, 10**10, 5)], "cell long, pos long, neg long, skipped long")
    got = M._auc_of_cells(cells, 6, True).first()
    pos, neg = [10**10, 3 * 10**10], [9 * 10**10, 10**10]
    want = (pos[0] * neg[0] / 2 + pos[1] * (neg[0] + neg[1] / 2)) / (sum(pos) * sum(neg))
    assert got.auc == pytest.approx(want, abs=1e-6) and got.skipped_rows == 5


def test_auc_passes_over_missing_labels_and_scores(spark):
    rows = [(0.9, 1), (0.4, 1), (0.6, 0), (0.2, 0)]
    extra = [(0.95, None)] * 5 + [(None, 1), (float("nan"), 0)]
    schema = "risk_score double, serious_delinquency int"
    plain = M.grid_auc(spark.createDataFrame(rows, schema)).first().auc
    more = M.grid_auc(spark.createDataFrame(rows + extra, schema), report_skipped=True).first()
    assert (more.auc, more.skipped_rows) == (plain, 7)
    assert M.grid_auc(spark.createDataFrame([], schema), report_skipped=True).first() == (None, 0)


def features(spark, n=150):
    accounts, bureau = fx.accounts(spark, "/root/testdata/sf0.001"), fx.bureau(spark, "/root/testdata/sf0.001")
    from credit_signals.operators.features import engineer_features
    return engineer_features(accounts, bureau).limit(n)


def test_run_time_is_an_instant_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        seconds = set()
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            scored = M.conform_scored(M.score_with_weights(features(spark, 1), run_ts="2001-11-05 12:00:00"))
            assert scored.schema["scored_at"].dataType == T.TimestampType()
            seconds.add(scored.select(F.unix_timestamp("scored_at")).first()[0])
        assert seconds == {int(dt.datetime(2001, 11, 5, 12, tzinfo=dt.timezone.utc).timestamp())}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_other_formats_get_the_eleven_columns(spark):
    scored = M.score_with_weights(features(spark), run_ts="2001-11-05 12:00:00")
    path = scratch_path(spark, "orc")
    W.write_scored(scored, path, fmt="orc", names=schemas.DDL_NAMES)
    names = [schemas.DDL_NAMES.get(n, n) for n in schemas.SCORED.fieldNames()]
    assert spark.read.orc(path).columns == names and "debt_stress" in names and len(names) == 11
    with pytest.raises(ValueError):
        W.write_scored(scored, path, fmt="orc", replace_days_only=True)
    with pytest.raises(ValueError):
        W.write_scored(scored, path, fmt="some.connector", by_day=True)


def test_written_rows_of_two_days(spark):
    path, target = scratch_path(spark, "features"), scratch_path(spark, "scored")
    W.write_features(features(spark), path)
    for day in (5, 6):
        r = jobs.run_scoring(spark, path, target, run_ts=f"2001-11-0{day} 12:00:00", replace_days_only=True)
        assert r.written_rows == 150
    assert W.read_scored(spark, target).count() == 300
    assert jobs.run_scoring(spark, path, scratch_path(spark, "orc"), fmt="orc").written_rows == 150


def test_grid_is_the_default_and_close_to_the_evaluator(spark):
    prepared = M.prepare_features(features(spark))
    assert M.train_model(prepared).auc == pytest.approx(M.train_model(prepared, auc="evaluator").auc, abs=1e-3)


def test_empty_inputs(spark):
    paths = {n: scratch_path(spark, f"empty-{n}") for n in ("accounts", "bureau", "out")}
    spark.createDataFrame([], schemas.ACCOUNTS).write.parquet(paths["accounts"])
    spark.createDataFrame([], schemas.BUREAU).write.parquet(paths["bureau"])
    r = jobs.run_features(spark, paths["accounts"], paths["bureau"], paths["out"])
    assert (r.accounts_loaded, r.bureau_loaded, r.total_accounts, r.high_risk_pct) == (0, 0, 0, None)
    v = jobs.run_verification(spark, paths["out"])
    assert (v.total_accounts, v.high_risk_pct, v.low_risk_pct, v.sample) == (0, None, None, [])


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_run_rules(spark):
    rows = [(1, None, "FAILED", 7), (2, " ", "FAILED", 7), (3, "ok", "FAILED", 8), (4, "ok", "COMPLETED", 7)]
    at = dt.datetime(2001, 1, 1)
    runs = spark.createDataFrame([(i, n, "risk_scorer", u, s, at, at, at, None, "e", None) for i, n, s, u in rows], schemas.RUN_LOG)
    assert {r.job_id: r.reason for r in RN.rejected_runs(runs).collect()} == {1: "missing job_name", 2: "missing job_name"}
    assert [r.status for r in RN.retry(runs, 1, 7, False).collect()] == ["PENDING"]
    assert RN.retry(runs, 3, 7, False).count() == 0 and RN.retry(runs, 3, 7, True).count() == 1
    assert RN.retry(runs, 4, 7, False).count() == 0
    assert [r.job_id for r in RN.page_after(runs, F.lit(at).cast("timestamp_ntz"), 3).collect()] == [2, 1]


def test_stream_reads_64_bit_files(spark):
    wide = T.StructType([T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType)
                         for f in schemas.ACCOUNTS.fields])
    src, out = scratch_path(spark, "wide"), scratch_path(spark, "stream")
    schemas.conform(fx.accounts(spark, "/root/testdata/sf0.001"), wide).write.parquet(src)
    bureau = fx.stage_inputs(spark, "/root/testdata/sf0.001")["bureau"]
    start_feature_stream(spark, src, bureau, out).awaitTermination()
    assert RD.read_features(spark, out).count() == 150


def test_entry_registers_the_catalogue(spark):
    import __spark_entry__ as E
    from credit_signals.plans import catalog
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())
