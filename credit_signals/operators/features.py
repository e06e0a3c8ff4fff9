"""Feature job: left join, default fill, three derived risk signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_signals.functions import rules as R
from credit_signals.operators.joins import left_join


def fill_bureau_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Per-column defaults for accounts without a bureau row (NULL and NaN)."""
    return df.fillna(dict(defaults or R.BUREAU_DEFAULTS))


def derive_signals(df: DataFrame, rules: R.RiskRules = R.DEFAULT_RULES) -> DataFrame:
    """Append delinquency_risk_score, debt_stress, high_risk_flag (in that order)."""
    scored = df.withColumn("delinquency_risk_score", R.delinquency_risk_score(rules))
    return scored.withColumns({
        "debt_stress": R.debt_stress(rules),
        "high_risk_flag": R.high_risk_flag(rules),
    })


def join_accounts_bureau(accounts: DataFrame, bureau: DataFrame, **join_opts) -> DataFrame:
    return left_join(accounts, bureau, "account_id", **join_opts)


def engineer_features(accounts: DataFrame, bureau: DataFrame,
                      rules: R.RiskRules = R.DEFAULT_RULES, **join_opts) -> DataFrame:
    """accounts LEFT JOIN bureau -> fill -> signals; 24 columns, flag last."""
    joined = join_accounts_bureau(accounts, bureau, **join_opts)
    return derive_signals(fill_bureau_defaults(joined), rules)


def high_risk(features: DataFrame) -> DataFrame:
    return features.where(F.col("high_risk_flag") == 1)
