"""In-line edge tables: thresholds at and beside each bound, NULL and NaN."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals.functions import rules as R
from credit_signals.operators import features as FT
from credit_signals.operators import model as M

NAN = float("nan")


def _frame(spark, rows):
    schema = T.StructType([T.StructField("credit_score", T.IntegerType()), T.StructField("debt_ratio", T.DoubleType()),
                           T.StructField("monthly_income", T.IntegerType()),
                           T.StructField("delinquency_30_days", T.IntegerType()),
                           T.StructField("delinquency_60_days", T.IntegerType()),
                           T.StructField("delinquency_90_days", T.IntegerType())])
    return FT.derive_signals(spark.createDataFrame(rows, schema))


@pytest.mark.parametrize("row,flag,stress,drs", [
    ((580, 0.2, 9000, 0, 0, 0), 0, 0, 0),        # 580 is not < 580
    ((579, 0.2, 9000, 0, 0, 0), 1, 0, 0),
    ((700, 0.5, 4000, 0, 0, 0), 0, 0, 0),        # 0.5 is not > 0.5
    ((700, 0.5000001, 4000, 0, 0, 0), 1, 1, 0),
    ((700, 0.6, 5000, 0, 0, 0), 1, 0, 0),        # 5000 is not < 5000
    ((700, 0.6, 4999, 0, 0, 0), 1, 1, 0),
    ((700, 0.2, 9000, 3, 0, 0), 1, 0, 3),        # 3 is inclusive
    ((700, 0.2, 9000, 0, 1, 0), 0, 0, 2),
    ((700, 0.2, 9000, 0, 0, 1), 1, 0, 3),
    ((None, 0.2, 9000, 0, 0, 0), 0, 0, 0),       # unknown -> 0
    ((None, 0.9, 9000, 0, 0, 0), 1, 0, 0),       # NULL OR TRUE -> 1
    ((700, None, 100, 0, 0, 0), 0, 0, 0),
    ((700, NAN, 100, 0, 0, 0), 1, 1, 0),         # NaN > 0.5 in Spark
    ((700, 0.2, 9000, None, 0, 1), 0, 0, None),  # NULL part -> NULL score
])
def test_signal_edges(spark, row, flag, stress, drs):
    r = _frame(spark, [row]).first()
    assert (r.high_risk_flag, r.debt_stress, r.delinquency_risk_score) == (flag, stress, drs)


@pytest.mark.parametrize("score,band", [
    (0.0, "LOW"), (0.3, "LOW"), (0.3000001, "MEDIUM"), (0.6, "MEDIUM"), (0.6000001, "HIGH"),
    (1.0, "HIGH"), (None, "HIGH"), (NAN, "HIGH"),
])
def test_band_edges(spark, score, band):
    df = spark.createDataFrame([(score,)], "risk_score double")
    assert df.select(R.risk_band("risk_score").alias("b")).first().b == band


def test_clip_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (NAN,), (-1.0,), (0.5,), (2.0,)], "x double")
    got = [r.c for r in df.select(R.clip("x", 0.0, 1.0).alias("c")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [0.0, 0.5, 1.0]


def test_fill_defaults_replace_null_and_nan(spark):
    df = spark.createDataFrame([("a", None, NAN, None), ("b", 7, 0.25, 2)],
                               "account_id string, bureau_score int, revolving_utilization double, "
                               "inquiries_last_6mo int")
    got = sorted(tuple(r) for r in FT.fill_bureau_defaults(df).collect())
    assert got == [("a", 0, 0.0, 0), ("b", 7, 0.25, 2)]


def test_scalar_fill_semantics(spark):
    df = spark.createDataFrame([(None, NAN, None)], "a int, b double, s string")
    r = df.fillna(0, subset=["a", "b", "s"]).first()
    assert (r.a, r.b, r.s) == (0, 0.0, None)          # string column ignored
    r = df.fillna(1.7, subset=["a"]).first()
    assert r.a == 1                                    # fractional default truncated for an int column


def test_one_class_training_set_raises(spark):
    df = spark.createDataFrame([(float(i), 0.0) for i in range(5)], "x double, serious_delinquency double")
    from pyspark.ml.feature import VectorAssembler
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    with pytest.raises(M.OneClassTrainingSet):
        M.fit(train)


def test_grid_auc_ties_and_extremes(spark):
    perfect = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "risk_score double, serious_delinquency int")
    assert M.grid_auc(perfect).first().auc == 1.0
    ties = spark.createDataFrame([(0.5, 0), (0.5, 1)], "risk_score double, serious_delinquency int")
    assert M.grid_auc(ties).first().auc == 0.5
    one_class = spark.createDataFrame([(0.5, 1)], "risk_score double, serious_delinquency int")
    assert M.grid_auc(one_class).first().auc is None


def test_empty_summary_share_is_null(spark):
    from credit_signals.operators.reports import feature_summary
    empty = spark.createDataFrame([], "high_risk_flag int")
    r = feature_summary(empty).first()
    assert (r.total_accounts, r.high_risk_accounts, r.high_risk_pct) == (0, 0, None)


def test_conform_raises_on_missing_column(spark):
    from credit_signals import schemas
    with pytest.raises(schemas.SchemaMismatch):
        schemas.conform(spark.createDataFrame([("a",)], "account_id string"), schemas.SCORED)


def test_scalar_fill_raises_on_unknown_column(spark):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(Exception):
        M.fill_feature_nulls(df, cols=("a", "no_such_column")).collect()
