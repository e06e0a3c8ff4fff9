"""One-pass summaries, samples and heads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_signals.functions.rules import LABEL_COL


def share(part: str | Column, total: str | Column, digits: int) -> Column:
    """``100 * part / total`` rounded; NULL (not an error) on an empty input."""
    p = F.col(part) if isinstance(part, str) else part
    t = F.col(total) if isinstance(total, str) else total
    return F.when(t > 0, F.round(p * 100.0 / t, digits))


def feature_summary(features: DataFrame) -> DataFrame:
    """Total accounts, flagged accounts and their share (2 decimals) in one pass."""
    counts = features.agg(F.count(F.lit(1)).alias("total_accounts"),
                          F.count_if(F.col("high_risk_flag") == 1).alias("high_risk_accounts"))
    return counts.withColumn("high_risk_pct", share("high_risk_accounts", "total_accounts", 2))


def verification_report(features: DataFrame) -> DataFrame:
    """Total / high / low with shares to 1 decimal, one pass over the table."""
    counts = features.agg(F.count(F.lit(1)).alias("total_accounts"),
                          F.count_if(F.col("high_risk_flag") == 1).alias("high_risk_accounts"),
                          F.count_if(F.col("high_risk_flag") == 0).alias("low_risk_accounts"))
    return counts.select("total_accounts", "high_risk_accounts",
                         share("high_risk_accounts", "total_accounts", 1).alias("high_risk_pct"),
                         "low_risk_accounts",
                         share("low_risk_accounts", "total_accounts", 1).alias("low_risk_pct"))


# Fixed value: the columns of the report's sample.
SAMPLE_COLUMNS = ("account_id", "credit_score", "debt_ratio", "delinquency_risk_score", "high_risk_flag")


def high_risk_sample(features: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` flagged accounts by key, five report columns."""
    return (features.where(F.col("high_risk_flag") == 1).select(*SAMPLE_COLUMNS)
            .orderBy("account_id").limit(n))


def head(df: DataFrame, n: int, key: str = "account_id") -> DataFrame:
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def default_rate(accounts: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """Mean of the 0/1 label, and as a percentage to 2 decimals."""
    return accounts.agg(F.count(F.lit(1)).alias("accounts"),
                        F.sum(label).cast("long").alias("defaults"),
                        F.avg(label).alias("default_rate")) \
        .withColumn("default_rate_pct", share("defaults", "accounts", 2))


def avg_credit_score(accounts: DataFrame) -> DataFrame:
    return accounts.agg(F.round(F.avg("credit_score"), 0).alias("avg_credit_score"))
