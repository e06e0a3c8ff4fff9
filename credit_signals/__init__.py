"""Credit-risk signals on Spark: feature join, risk rules, scoring, reports.

Everything runs as DataFrame / Spark ML plans; no Python UDFs.  The names
below are the public API (one per step of the two batch jobs):

    session                      start or reuse a session (shared folder set up)
    read_accounts / read_bureau  scans with declared schemas (path or catalog table)
    read_features                the flag-partitioned feature table
    engineer_features            left join, default fill, three risk signals
    write_features               Parquet, partitioned by the flag
    prepare_features             fill, assemble the vector, cast the label
    train_model                  split, fit, AUC on the test split
    score_accounts               probability, band, version, run time
    write_scored                 conform to the warehouse schema and overwrite
    run_features / run_scoring   the two jobs end to end
    run_verification             counts, shares and a sample of a feature table
"""

__version__ = "0.1.0"

from credit_signals.operators.features import engineer_features
from credit_signals.operators.model import prepare_features, score_accounts, train_model
from credit_signals.plans.jobs import run_features, run_scoring, run_verification
from credit_signals.session import session
from credit_signals.sinks.writers import write_features, write_scored
from credit_signals.sources.readers import read_accounts, read_bureau, read_features

__all__ = [
    "engineer_features", "prepare_features", "read_accounts", "read_bureau", "read_features",
    "run_features", "run_scoring", "run_verification", "score_accounts", "session", "train_model",
    "write_features", "write_scored",
]
