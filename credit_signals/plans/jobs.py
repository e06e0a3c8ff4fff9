"""The two batch jobs, end to end.

The join runs once, for the write, and every count comes from that write: the
rows of both inputs, the feature rows and the flagged ones are observed while
they pass, the scored rows while they are written (or from the commit messages
of the warehouse connector).  The reference read and joined again for each count.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from credit_signals.functions import rules as R
from credit_signals.operators import features as FT
from credit_signals.operators import joins as J
from credit_signals.operators import model as M
from credit_signals.session import observing_session
from credit_signals.sinks import warehouse
from credit_signals.sinks import writers as W
from credit_signals.sources import readers as RD
from credit_signals.sources.fixtures import has_unique_keys


@dataclass
class FeatureJobResult:
    accounts_loaded: int
    bureau_loaded: int
    total_accounts: int
    high_risk_accounts: int
    high_risk_pct: float | None
    path: str


def run_features(spark: SparkSession, accounts_path: str, bureau_path: str, out_path: str,
                 rules: R.RiskRules = R.DEFAULT_RULES, compact: bool = False, publish: bool = False,
                 **join_opts) -> FeatureJobResult:
    """Read both inputs (paths or bucketed catalog tables), derive the feature
    table, write it partitioned by flag.

    With ``publish`` the table at ``out_path`` is versioned: readers of
    ``read_published_features`` see the old version until this one is complete.
    Input rows are counted as they pass; only a join that is split for hot keys
    reads its inputs more than once, and then their footers give the counts.
    """
    work = observing_session(spark)
    accounts = RD.read_accounts(work, accounts_path)
    bureau = RD.read_bureau(work, bureau_path)
    unique = has_unique_keys(accounts_path) and has_unique_keys(bureau_path)
    seen = {}
    if unique or not join_opts.get("skew_guard", True) or J.broadcast_planned(bureau):
        join_opts = {**join_opts, "skew_guard": False}
        accounts, seen["accounts"] = W.counted(accounts)
        bureau, seen["bureau"] = W.counted(bureau)
    flagged = F.count_if(F.col(W.FEATURE_PARTITION) == 1)
    features, written = W.counted(FT.engineer_features(accounts, bureau, rules, **join_opts), flagged=flagged)
    if publish:
        W.publish_features(features, out_path, written, compact=compact)
    else:
        W.write_features(features, out_path, compact=compact)
    # an input that the plan dropped as empty was never observed
    loaded = {name: W.observed(seen[name]).get("rows") if name in seen else None for name in ("accounts", "bureau")}
    n_accounts = accounts.count() if loaded["accounts"] is None else loaded["accounts"]
    n_bureau = bureau.count() if loaded["bureau"] is None else loaded["bureau"]
    out = W.observed(written)
    total, high = out.get("rows", 0), out.get("flagged", 0)
    pct = round(high * 100.0 / total, 2) if total else None
    return FeatureJobResult(n_accounts, n_bureau, total, high, pct, out_path)


@dataclass
class ScoringJobResult:
    model: object
    auc: float
    train_rows: int
    test_rows: int
    written_rows: int
    target: str


def run_scoring(spark: SparkSession, features_path: str, target: str, fmt: str = "parquet",
                options: dict | None = None, run_ts: str | _dt.datetime | None = None,
                split: str = "hash", max_iter: int = M.MAX_ITER, auc: str = "grid",
                replace_days_only: bool = False, names: dict[str, str] | None = None) -> ScoringJobResult:
    """Fit on the train split, report AUC on the test split, score every
    account, band it, and overwrite the warehouse table.

    All accounts are scored with the fitted weights as a column expression
    (equal to ``model.transform`` within 1e-12, tested): the scoring stage
    stays in whole-stage codegen and builds no vector per row.
    """
    prepared = M.prepare_features(RD.read_features(spark, features_path))
    trained = M.train_model(prepared, split=split, max_iter=max_iter, auc=auc)
    told = fmt == warehouse.FORMAT        # the connector's tasks tell what they wrote; other rows are observed
    features = M.fill_feature_nulls(RD.read_features(spark if told else observing_session(spark), features_path))
    scored = M.score_with_weights(features.withColumn(R.LABEL_COL, F.col(R.LABEL_COL).cast("double")),
                                  M.LinearScore.from_model(trained.model), run_ts=run_ts)
    seen = None
    if not told:
        scored, seen = W.counted(scored)
    written = W.write_scored(scored, target, fmt=fmt, options=options, replace_days_only=replace_days_only, names=names)
    if seen is not None:
        written = W.observed(seen).get("rows", 0)
    return ScoringJobResult(trained.model, trained.auc, trained.train_rows, trained.test_rows,
                            written, target)


@dataclass
class VerificationResult:
    total_accounts: int
    high_risk_accounts: int
    high_risk_pct: float | None
    low_risk_accounts: int
    low_risk_pct: float | None
    sample: list


def run_verification(spark: SparkSession, features_path: str, sample_rows: int = 5) -> VerificationResult:
    """Counts and shares of the written feature table (one pass over the
    partition column only) and the first flagged accounts (one pruned folder)."""
    from credit_signals.operators import reports as RP
    features = RD.read_features(spark, features_path)
    r = RP.verification_report(features).first()
    sample = [row.asDict() for row in RP.high_risk_sample(features, sample_rows).collect()]   # <= sample_rows
    return VerificationResult(r["total_accounts"], r["high_risk_accounts"], r["high_risk_pct"],
                              r["low_risk_accounts"], r["low_risk_pct"], sample)


def run_smoke(spark: SparkSession, accounts: str, rows: int = 5) -> dict:
    """Read an accounts table: its row count, its columns and its first rows by key."""
    df = RD.read_accounts(spark, accounts)
    count = RD.load_counts({"accounts": df}).first()["row_count"]
    columns = [tuple(r) for r in RD.schema_profile(df).collect()]             # one row per column
    first = [r.asDict() for r in RD.preview(df, rows).collect()]               # <= rows
    return {"row_count": count, "columns": columns, "first_rows": first}


def main(argv: list[str] | None = None) -> int:
    """``python -m credit_signals.plans.jobs <stage|features|scoring|verify|smoke> ...``"""
    import argparse
    import json

    from credit_signals.session import session, sizing_conf
    from credit_signals.sources import fixtures

    ap = argparse.ArgumentParser(prog="credit_signals.plans.jobs")
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-gb", type=int, default=None, help="size partitions for this much input ...")
    ap.add_argument("--cores", type=int, default=None, help="... on this many cores")
    sub = ap.add_subparsers(dest="job", required=True)
    st = sub.add_parser("stage", help="derive accounts and bureau tables from the driver tables")
    st.add_argument("--tables", required=True)
    fe = sub.add_parser("features", help="feature job")
    fe.add_argument("--accounts", required=True)
    fe.add_argument("--bureau", required=True)
    fe.add_argument("--out", required=True)
    fe.add_argument("--publish", action="store_true", help="write a new version of a versioned table")
    fe.add_argument("--compact", action="store_true", help="rebalance on the flag before writing")
    fe.add_argument("--buckets", type=int, default=None,
                    help="inputs are staged bucketed files with this bucket count: register them as tables")
    sc = sub.add_parser("scoring", help="scoring job")
    sc.add_argument("--features", required=True)
    sc.add_argument("--target", required=True)
    sc.add_argument("--format", default="parquet")
    sc.add_argument("--option", action="append", default=[], help="key=value writer option")
    sc.add_argument("--run-ts", default=None)
    sc.add_argument("--replace-days-only", action="store_true", help="dynamic overwrite of the written days")
    sc.add_argument("--auc", choices=("evaluator", "grid"), default="grid")
    ve = sub.add_parser("verify", help="verification report of a feature table")
    ve.add_argument("--features", required=True)
    sm = sub.add_parser("smoke", help="row count, column list and first rows of an accounts table")
    sm.add_argument("--accounts", required=True)
    sm.add_argument("--rows", type=int, default=5)
    args = ap.parse_args(argv)

    sizes = sizing_conf(args.input_gb << 30, args.cores) if args.input_gb and args.cores else None
    spark = session(f"credit-signals-{args.job}", master=args.master, extra_conf=sizes)
    if args.job == "stage":
        out = fixtures.stage_inputs(spark, args.tables)
    elif args.job == "features":
        accounts, bureau = args.accounts, args.bureau
        if args.buckets:
            from credit_signals import schemas
            accounts = RD.register_bucketed(spark, accounts, schemas.ACCOUNTS, args.buckets)
            bureau = RD.register_bucketed(spark, bureau, schemas.BUREAU, args.buckets)
        r = run_features(spark, accounts, bureau, args.out, compact=args.compact, publish=args.publish)
        out = r.__dict__
    elif args.job == "scoring":
        opts = dict(o.split("=", 1) for o in args.option)
        r = run_scoring(spark, args.features, args.target, fmt=args.format, options=opts, run_ts=args.run_ts,
                        auc=args.auc, replace_days_only=args.replace_days_only)
        out = {k: v for k, v in r.__dict__.items() if k != "model"}
    elif args.job == "verify":
        out = run_verification(spark, args.features).__dict__
    else:
        out = run_smoke(spark, args.accounts, args.rows)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
