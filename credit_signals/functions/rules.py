"""Risk rules as column expressions.

Each function returns a ``Column`` so the same rule serves the batch jobs, the
registered queries, the streaming variant and the tests.  All of them are
built-in Catalyst expressions (whole-stage codegen, no Python in the plan).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
LABEL_COL = "serious_delinquency"
MODEL_VERSION = "1.0.0"
FEATURE_COLS = (
    "credit_score",
    "debt_ratio",
    "monthly_income",
    "delinquency_risk_score",
    "debt_stress",
    "bureau_score",
    "revolving_utilization",
    "inquiries_last_6mo",
)
BUREAU_DEFAULTS = {"bureau_score": 0, "revolving_utilization": 0.0, "inquiries_last_6mo": 0}
LOW_THRESHOLD = 0.3
MEDIUM_THRESHOLD = 0.6
AUC_GOOD = 0.7
# Rule prior of the label, in thousandths: base 0.05, +0.15 credit score
# below 580, +0.10 debt ratio above 0.5, +0.08 any 90-day delinquency,
# +0.05 any time 90 days late; clipped to [0, 1].
PRIOR_BASE = 50
PRIOR_LOW_CREDIT = 150
PRIOR_HIGH_DEBT = 100
PRIOR_DELINQUENT_90 = 80
PRIOR_LATE_90 = 50
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskRules:
    """Thresholds and weights of the three risk signals and the bands."""

    credit_score_floor: int = 580      # credit_score <  floor  -> signal
    delinquency_limit: int = 3         # risk score    >= limit  -> signal (inclusive)
    debt_ratio_limit: float = 0.5      # debt_ratio    >  limit  -> signal
    income_limit: int = 5000           # monthly_income < limit  (debt stress)
    weight_90: int = 3
    weight_60: int = 2
    weight_30: int = 1
    low_band: float = LOW_THRESHOLD    # score <= low              -> LOW
    medium_band: float = MEDIUM_THRESHOLD  # low < score <= medium -> MEDIUM


DEFAULT_RULES = RiskRules()


def _c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def delinquency_risk_score(rules: RiskRules = DEFAULT_RULES) -> Column:
    """Weighted delinquency count; NULL if any part is NULL."""
    return (F.col("delinquency_90_days") * rules.weight_90
            + F.col("delinquency_60_days") * rules.weight_60
            + F.col("delinquency_30_days") * rules.weight_30)


def debt_stress(rules: RiskRules = DEFAULT_RULES) -> Column:
    """1 when debt ratio is high AND income is low (both strict); unknown -> 0."""
    return F.when((F.col("debt_ratio") > rules.debt_ratio_limit)
                  & (F.col("monthly_income") < rules.income_limit), 1).otherwise(0)


def high_risk_signals(rules: RiskRules = DEFAULT_RULES) -> Column:
    """The three-way OR as a nullable boolean (three-valued logic)."""
    return ((F.col("credit_score") < rules.credit_score_floor)
            | (F.col("delinquency_risk_score") >= rules.delinquency_limit)
            | (F.col("debt_ratio") > rules.debt_ratio_limit))


def high_risk_flag(rules: RiskRules = DEFAULT_RULES) -> Column:
    """1 when any signal holds; an all-unknown condition falls to 0."""
    return F.when(high_risk_signals(rules), 1).otherwise(0)


def risk_band(score: str | Column = "risk_score", rules: RiskRules = DEFAULT_RULES) -> Column:
    """LOW / MEDIUM / HIGH; upper bounds inclusive; NULL and NaN fall to HIGH."""
    s = _c(score)
    return (F.when(s <= rules.low_band, "LOW")
            .when(s <= rules.medium_band, "MEDIUM")
            .otherwise("HIGH"))


def clip(x: str | Column, lo, hi) -> Column:
    """Bound a numeric column like ``np.clip``: NULL stays NULL, NaN stays NaN.

    ``least``/``greatest`` alone would skip a NULL and turn it into a bound.
    """
    c = _c(x)
    bounded = F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
    return F.when(c.isNull() | F.isnan(c), c).otherwise(bounded)


def rule_prior_thousandths() -> Column:
    """Rule prior of a default, in integer thousandths (exact sums)."""
    return (F.lit(PRIOR_BASE)
            + F.when(F.col("credit_score") < 580, PRIOR_LOW_CREDIT).otherwise(0)
            + F.when(F.col("debt_ratio") > 0.5, PRIOR_HIGH_DEBT).otherwise(0)
            + F.when(F.col("delinquency_90_days") > 0, PRIOR_DELINQUENT_90).otherwise(0)
            + F.when(F.col("times_90_days_late") > 0, PRIOR_LATE_90).otherwise(0))


def rule_default_prob() -> Column:
    """Rule prior as a probability, clipped to [0, 1]."""
    return clip(rule_prior_thousandths() / 1000.0, 0.0, 1.0)


def hash_bucket(key: str | Column = "account_id", buckets: int = 10) -> Column:
    """Stable bucket from the first 8 hex digits of md5(key); same in any engine."""
    return F.conv(F.substring(F.md5(_c(key)), 1, 8), 16, 10).cast("long") % buckets


def date_text(base: str, days: str | Column) -> Column:
    """``base + days`` as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_add(F.to_date(F.lit(base)), _c(days).cast("int")), "yyyy-MM-dd")
