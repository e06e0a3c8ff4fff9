"""Golden values of FIXTURES.md section 7."""

import pytest
from pyspark.sql import functions as F

from paths import SF001, SF01
from credit_signals.plans import catalog as C
from credit_signals.sources import fixtures as fx
from credit_signals.operators.features import engineer_features, join_accounts_bureau


def _features(spark, sf):
    return engineer_features(fx.accounts(spark, sf), fx.bureau(spark, sf))


@pytest.mark.parametrize("sf,expect", [
    (SF001, dict(n=150, bureau=135, missing=15, flag=78, stress=12, label=18, drs=209, cs=44, inc=70)),
    (SF01, dict(n=1500, bureau=1350, missing=150, flag=785, stress=129, label=177, drs=1986, cs=425, inc=706)),
])
def test_feature_counts(spark, sf, expect):
    f = _features(spark, sf)
    r = f.agg(F.count(F.lit(1)).alias("n"),
              F.count_if(F.col("bureau_updated_date").isNull()).alias("missing"),
              F.count_if(F.col("high_risk_flag") == 1).alias("flag"),
              F.count_if(F.col("debt_stress") == 1).alias("stress"),
              F.sum("serious_delinquency").alias("label"),
              F.sum("delinquency_risk_score").alias("drs"),
              F.count_if(F.col("credit_score") < 580).alias("cs"),
              F.count_if(F.col("monthly_income") < 5000).alias("inc")).first().asDict()
    r["bureau"] = fx.bureau(spark, sf).count()
    assert r == expect


def test_split_and_prior(spark):
    rows = {r["split"]: r["row_count"] for r in C.split_counts(spark, SF001).collect()}
    assert rows["train"] == 117 and rows["train"] + rows["test"] == 150
    r = C.expected_vs_observed(spark, SF001).first()
    assert (r.expected_rate, r.observed_rate) == (0.124333, 0.12)
    assert C.rule_calibration(spark, SF001).count() == 13


@pytest.mark.parametrize("sf,bands,auc", [(SF001, (47, 63, 40), 0.603325), (SF01, (476, 635, 389), 0.690878)])
def test_pinned_bands_and_auc(spark, sf, bands, auc):
    got = {r["risk_band"]: r["accounts"] for r in C.risk_band_counts(spark, sf).collect()}
    assert (got["LOW"], got["MEDIUM"], got["HIGH"]) == bands
    assert C.auc_pinned(spark, sf).first()["auc"] == auc


def test_dirty_counts(spark):
    f = engineer_features(fx.dirty_accounts(fx.accounts(spark, SF001)), fx.bureau(spark, SF001))
    r = f.agg(F.count_if(F.col("delinquency_risk_score").isNull()).alias("null_score"),
              F.count_if(F.col("high_risk_flag") == 1).alias("flag"),
              F.count_if(F.col("debt_stress") == 1).alias("stress"),
              F.count_if(F.isnan("debt_ratio")).alias("nan")).first()
    assert tuple(r) == (9, 80, 14, 7)


def test_fanout_and_null_keys(spark):
    a, b = fx.accounts(spark, SF001), fx.bureau(spark, SF001)
    dup = join_accounts_bureau(a, fx.duplicated_bureau(b))
    assert (dup.count(), dup.where(F.col("bureau_score").isNotNull()).count()) == (153, 138)
    nk = join_accounts_bureau(fx.null_keys(a), fx.null_keys(b))
    assert (nk.count(), nk.where(F.col("bureau_score").isNotNull()).count()) == (150, 131)


def test_run_log_status_counts(spark):
    got = {r["status"]: r["count"] for r in fx.run_log(spark, SF001).groupBy("status").count().collect()}
    assert (got["FAILED"], got["PENDING"], got["CANCELLED"], got["COMPLETED"]) == (493, 157, 8, 328)


def test_fitted_model_within_tolerance(spark):
    coef = {r.term: r.weight for r in C.model_coefficients(spark, SF01).collect()}
    expect = {"intercept": -0.044075, "credit_score": -0.004541, "debt_ratio": 1.427188,
              "monthly_income": 0.000051, "delinquency_risk_score": 0.090435, "debt_stress": 1.048218,
              "bureau_score": -0.000181, "revolving_utilization": 0.517447, "inquiries_last_6mo": -0.140917}
    for k, v in expect.items():
        assert coef[k] == pytest.approx(v, abs=2e-6), k
    auc = C.model_auc(spark, SF01).first()
    assert (auc.train_rows, auc.test_rows) == (1193, 307)
    assert auc.auc == pytest.approx(0.685924, abs=1e-3)
