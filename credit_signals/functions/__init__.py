"""Pure column expressions: every business rule is ``(...) -> Column``."""

from credit_signals.functions.rules import (  # noqa: F401
    BUREAU_DEFAULTS, DEFAULT_RULES, FEATURE_COLS, LABEL_COL, MODEL_VERSION, RiskRules,
    clip, debt_stress, delinquency_risk_score, hash_bucket, high_risk_flag, risk_band,
    rule_prior_thousandths, rule_default_prob,
)
