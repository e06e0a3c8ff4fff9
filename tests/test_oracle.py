"""Every registered query against its DuckDB oracle (row count, names, exact values)."""

import pytest

import __spark_entry__ as E
from compare import compare
from paths import SF001
from credit_signals.plans import catalog

SQL = catalog.oracle_sql()
ALL = catalog.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck001, name):
    assert compare(ALL[name](spark, SF001), duck001, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert ALL[name](spark, SF001).count() > 0


def test_every_query_has_sql_or_is_declared_rows_only():
    from credit_signals.plans.catalog import ROWS_ONLY
    assert set(ALL) == set(SQL) | ROWS_ONLY
    assert ROWS_ONLY == {"model_coefficients", "model_auc", "scored_accounts", "positive_probability",
                         "random_split_counts", "fit_losses"}


def test_entry_is_flagship(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["account_id", "score", "risk_band"]
    assert df.count() == 150


AT_DRIVER_SCALE = ("feature_summary", "join_fanout", "join_null_keys", "high_risk_flag_nulls", "auc_pinned",
                   "risk_band_counts", "rule_calibration", "runs_page", "runs_owner_name", "verification_report")


@pytest.fixture(scope="module")
def duck01():
    from compare import duck
    from paths import SF01
    return duck(SF01)


@pytest.mark.parametrize("name", AT_DRIVER_SCALE)
def test_query_matches_oracle_at_driver_scale(spark, duck01, name):
    from paths import SF01
    assert compare(ALL[name](spark, SF01), duck01, SQL[name]) is None
