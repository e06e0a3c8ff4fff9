"""Invariants: join counts, band partition, split sizes, weights vs model."""

from pyspark.sql import functions as F

from paths import SF001
from credit_signals.operators import features as FT
from credit_signals.operators import model as M
from credit_signals.sources import fixtures as fx


def test_left_join_count_is_sum_of_max_one_matches(spark):
    a, b = fx.accounts(spark, SF001), fx.duplicated_bureau(fx.bureau(spark, SF001))
    matches = a.join(b.groupBy("account_id").count(), "account_id", "left")
    expect = matches.agg(F.sum(F.greatest(F.coalesce("count", F.lit(0)), F.lit(1)))).first()[0]
    assert FT.join_accounts_bureau(a, b).count() == expect


def test_bands_partition_rows_and_flag_halves(spark):
    f = FT.engineer_features(fx.accounts(spark, SF001), fx.bureau(spark, SF001))
    s = M.score_with_weights(f)
    assert s.where(F.col("risk_band").isin("LOW", "MEDIUM", "HIGH")).count() == s.count() == 150
    r = f.agg(F.count_if(F.col("high_risk_flag") == 1), F.count_if(F.col("high_risk_flag") == 0)).first()
    assert r[0] + r[1] == 150


def test_flag_is_monotone_in_each_signal(spark):
    f = FT.engineer_features(fx.accounts(spark, SF001), fx.bureau(spark, SF001))
    worse = f.withColumns({"credit_score": F.col("credit_score") - 100,
                           "delinquency_90_days": F.col("delinquency_90_days") + 1})
    worse = FT.derive_signals(worse.drop("delinquency_risk_score", "debt_stress", "high_risk_flag"))
    joined = f.select("account_id", F.col("high_risk_flag").alias("a")).join(
        worse.select("account_id", F.col("high_risk_flag").alias("b")), "account_id")
    assert joined.where(F.col("b") < F.col("a")).count() == 0


def test_weights_from_model_equal_model_scores(spark):
    prepared = M.prepare_features(FT.engineer_features(fx.accounts(spark, SF001), fx.bureau(spark, SF001)))
    res = M.train_model(prepared)
    by_model = M.score_accounts(res.model, prepared).select("account_id", F.col("risk_score").alias("m"))
    by_expr = prepared.select("account_id", M.LinearScore.from_model(res.model).probability().alias("w"))
    diff = by_model.join(by_expr, "account_id").agg(F.max(F.abs(F.col("m") - F.col("w")))).first()[0]
    assert diff < 1e-12
    assert res.train_rows + res.test_rows == 150


def test_random_split_covers_all_rows(spark):
    prepared = M.prepare_features(FT.engineer_features(fx.accounts(spark, SF001), fx.bureau(spark, SF001)))
    train, test = M.random_split(prepared)
    assert train.count() + test.count() == 150


def test_grid_auc_option_is_close_to_evaluator(spark):
    prepared = M.prepare_features(FT.engineer_features(fx.accounts(spark, SF001), fx.bureau(spark, SF001)))
    a = M.train_model(prepared).auc
    b = M.train_model(prepared, auc="grid").auc
    assert abs(a - b) < 5e-3
