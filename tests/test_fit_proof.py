"""The fit against its own first step, and the exact AUC against all pairs."""

import math
import random

import numpy as np
import pytest
from paths import SF001, SF01

from credit_signals.functions import rules as R
from credit_signals.operators import model as M
from credit_signals.plans import catalog, catalog_tables


def test_first_step_equals_numpy(spark):
    features = catalog._features(spark, SF001)
    step = M.newton_step(M.moment_sums(features))
    rows = M.unpack_features(M.prepare_features(features)).join(features.select("account_id", R.LABEL_COL), "account_id").collect()
    x = np.array([[1.0, *[r[c] for c in R.FEATURE_COLS]] for r in rows])
    y = np.array([float(r[R.LABEL_COL]) for r in rows])
    want = np.linalg.lstsq(x.T @ x / 4, x.T @ (y - 0.5), rcond=None)[0]
    got = np.array([step.intercept, *[w for _, w, _ in step.terms]])
    assert np.allclose(x @ got, x @ want, atol=1e-6)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_the_fit_is_better_than_its_first_step(spark, sf):
    losses = {r["split"]: r for r in catalog_tables.fit_losses(spark, sf).collect()}
    train = losses["train"]
    assert math.isclose(train["zero_loss"], math.log(2), rel_tol=1e-12)
    assert train["fitted_loss"] < train["step_loss"] < train["zero_loss"]
    assert losses["train"]["rows"] + losses["test"]["rows"] == catalog._features(spark, sf).count()


def test_a_wrong_fit_is_seen(spark):
    features = catalog._features(spark, SF001)
    good = M.newton_step(M.moment_sums(features))
    wrong = M.LinearScore(tuple((c, -w, k) for c, w, k in good.terms), -good.intercept, None)
    r = M.log_losses(features, {"good": good, "wrong": wrong}).first()
    assert r["good"] < math.log(2) < r["wrong"]


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1 and s is not None and not math.isnan(s)]
    neg = [s for s, y in rows if y == 0 and s is not None and not math.isnan(s)]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", range(4))
def test_exact_auc(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([rng.random(), 0.5, 0.25, None, float("nan"), -0.0, 0.0]), rng.choice([0, 1, 1, None, 2]))
            for _ in range(300)]
    got = M.exact_auc(spark.createDataFrame(rows, "risk_score double, serious_delinquency int").repartition(7)).first()
    assert math.isclose(got["auc"], brute_auc(rows), abs_tol=1e-11)


def test_exact_auc_of_one_class_or_nothing(spark):
    schema = "risk_score double, serious_delinquency int"
    assert tuple(M.exact_auc(spark.createDataFrame([(0.5, 1)], schema)).first()) == (None, 1, 0)
    assert tuple(M.exact_auc(spark.createDataFrame([], schema)).first()) == (None, 0, 0)


def test_exact_auc_has_no_single_task_window_over_the_rows(spark):
    plan = M.exact_auc(catalog._pinned(spark, SF001))._jdf.queryExecution().toString()
    over = [line for line in plan.splitlines() if "Window" in line and "part_neg" not in line]
    assert over and all("[part" in line for line in over)
