"""Registered queries (``queries()``) and their SQL oracle (``oracle_sql()``).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables or tables Spark derived from them.  Queries without an SQL form
(model fit, random split) are listed in ``ROWS_ONLY`` and checked by tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_signals import schemas
from credit_signals.functions import rules as R
from credit_signals.operators import features as FT
from credit_signals.operators import joins as J
from credit_signals.operators import model as M
from credit_signals.operators import reports as RP
from credit_signals.operators import runs as RN
from credit_signals.plans import oracle as O
from credit_signals.session import app_id, scratch_path
from credit_signals.sinks import writers as W
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD

RUN_TS = O.RUN_TS
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
ROWS_ONLY: set[str] = set()


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is None:
            ROWS_ONLY.add(name)
        else:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- shared inputs ----------------------------------------------------------------

def _acc(spark, sf):
    return fx.accounts(spark, sf)


def _bur(spark, sf):
    return fx.bureau(spark, sf)


def _features(spark, sf) -> DataFrame:
    return FT.engineer_features(_acc(spark, sf), _bur(spark, sf), skew_guard=False)


def _dirty_features(spark, sf) -> DataFrame:
    return FT.engineer_features(fx.dirty_accounts(_acc(spark, sf)), _bur(spark, sf))


def _pinned(spark, sf) -> DataFrame:
    return M.score_with_weights(_features(spark, sf), run_ts=RUN_TS)


def _runs(spark, sf) -> DataFrame:
    return fx.run_log(spark, sf)


def _current_user(runs: DataFrame):
    """The caller of the console queries: the submitter of the newest job.

    A request's user is known before the query runs, so it is resolved first
    (one-row aggregate) and used as a literal, which reaches the Parquet scan
    as a pushed filter (a scalar-subquery comparison would not).
    """
    return runs.agg(F.max_by("submitted_by", "job_id")).first()[0]


BASE = O.base_ctes()
FEAT = BASE + O.features_ctes()
DIRTY = BASE + [O.dirty_cte()] + O.features_ctes("accounts_dirty", "bureau", "features")
SCORED = FEAT + O.scored_ctes()
RUNS = O.runs_ctes()
ACC_COLS = ", ".join(O.ACCOUNT_COLS)

# --- 2.1 scans / sources ---------------------------------------------------------------


@register("scan_accounts", O.sql(BASE, "SELECT * FROM accounts"))
def scan_accounts(spark, sf):
    return _acc(spark, sf)


@register("scan_bureau", O.sql(BASE, "SELECT * FROM bureau"))
def scan_bureau(spark, sf):
    return _bur(spark, sf)


@register("load_counts", O.sql(BASE, "SELECT 'accounts' AS table_name, count(*) AS row_count FROM accounts "
                                      "UNION ALL SELECT 'bureau', count(*) FROM bureau"))
def load_counts(spark, sf):
    return RD.load_counts({"accounts": _acc(spark, sf), "bureau": _bur(spark, sf)})


_TYPES_SQL = " ".join(f"WHEN '{d}' THEN '{t}'" for d, t in (
    ("BIGINT", "bigint"), ("INTEGER", "int"), ("DOUBLE", "double"), ("VARCHAR", "string"), ("TIMESTAMP", "timestamp_ntz")))


@register("schema_profile", "SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name, "
                            f"CASE column_type {_TYPES_SQL} ELSE column_type END AS data_type, "
                            "\"null\" = 'YES' AS nullable FROM (DESCRIBE orders)")
def schema_profile(spark, sf):
    """Column list of a given table as its files declare it."""
    return RD.schema_profile(fx.table(spark, sf, "orders"))


_WIDE_KEY = "o_orderkey + 10000000000"


@register("account_keys_wide", "SELECT count(*) AS keys, count(DISTINCT concat('A', CAST(" + _WIDE_KEY + " AS VARCHAR))) "
                               "AS distinct_ids, min(concat('A', CAST(" + _WIDE_KEY + " AS VARCHAR))) AS first_id, "
                               "max(" + _WIDE_KEY + ") AS last_number FROM orders")
def account_keys_wide(spark, sf):
    """Ids of numbers with more than nine digits stay apart and give their number back."""
    ids = fx.table(spark, sf, "orders").select(fx.account_key(F.expr(_WIDE_KEY)).alias("account_id"))
    return ids.agg(F.count(F.lit(1)).alias("keys"), F.count_distinct("account_id").alias("distinct_ids"),
                   F.min("account_id").alias("first_id"), F.max(fx.key_number()).alias("last_number"))


@register("preview_accounts", O.sql(BASE, "SELECT * FROM accounts ORDER BY account_id LIMIT 5"))
def preview_accounts(spark, sf):
    return RD.preview(_acc(spark, sf), 5)


# --- 2.5 joins -------------------------------------------------------------------------


@register("join_accounts_bureau", O.sql(BASE + [O.joined_cte()], "SELECT * FROM joined"))
def join_accounts_bureau(spark, sf):
    return FT.join_accounts_bureau(_acc(spark, sf), _bur(spark, sf), skew_guard=False)


@register("join_fanout", O.sql(BASE + [O.bureau_dup_cte(), O.joined_cte("accounts", "bureau_dup")],
                               "SELECT * FROM joined"))
def join_fanout(spark, sf):
    return FT.join_accounts_bureau(_acc(spark, sf), fx.duplicated_bureau(_bur(spark, sf)))


@register("join_null_keys", O.sql(BASE + [O.null_key_cte("accounts", O.ACCOUNT_COLS, "acc_nk"),
                                          O.null_key_cte("bureau", O.BUREAU_COLS, "bur_nk"),
                                          O.joined_cte("acc_nk", "bur_nk")],
                                  "SELECT * FROM joined"))
def join_null_keys(spark, sf):
    return FT.join_accounts_bureau(fx.null_keys(_acc(spark, sf)), fx.null_keys(_bur(spark, sf)))


# Orders are all hot on their priority (five values): the grid path itself, on whole given tables.
_BY_PRIORITY = "SELECT o_orderpriority, count(*) AS orders_of_priority FROM orders GROUP BY o_orderpriority"
HOT_SLICE_ROWS = 200


def _split_join(left, right, key):
    return J.left_join(left, right, key, slice_rows=HOT_SLICE_ROWS, always_split=True)


def _priorities(orders):
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders_of_priority"))


@register("join_hot_left", f"SELECT o_orderpriority, o_orderkey, orders_of_priority FROM orders LEFT JOIN ({_BY_PRIORITY}) p "
                           "USING (o_orderpriority)")
def join_hot_left(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return _split_join(orders.select("o_orderpriority", "o_orderkey"), _priorities(orders), "o_orderpriority")


@register("join_hot_right", f"SELECT o_orderpriority, orders_of_priority, o_orderkey FROM ({_BY_PRIORITY}) p LEFT JOIN "
                            "(SELECT o_orderpriority, o_orderkey FROM orders) o USING (o_orderpriority)")
def join_hot_right(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return _split_join(_priorities(orders), orders.select("o_orderpriority", "o_orderkey"), "o_orderpriority")


@register("join_hot_null_keys", "SELECT o_orderpriority, o_orderkey, orders_of_priority FROM (SELECT CASE WHEN o_orderkey % 41 = 2 "
                                f"THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderkey FROM orders) o "
                                f"LEFT JOIN ({_BY_PRIORITY}) p USING (o_orderpriority)")
def join_hot_null_keys(spark, sf):
    orders = fx.table(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 41 != 2, F.col("o_orderpriority")).alias("o_orderpriority")
    return _split_join(orders.select(key, "o_orderkey"), _priorities(orders), "o_orderpriority")


# --- 2.3 fills, projections, scalar expressions ----------------------------------------------

_BUREAU_OUT = ", ".join(O.BUREAU_COLS)


@register("fill_bureau_defaults", O.sql(BASE + O.features_ctes(), f"SELECT {_BUREAU_OUT} FROM features_f"))
def fill_bureau_defaults(spark, sf):
    joined = FT.join_accounts_bureau(_acc(spark, sf), _bur(spark, sf), skew_guard=False)
    return FT.fill_bureau_defaults(joined).select(*O.BUREAU_COLS)


_FEATURE_FILL_SQL = ", ".join(
    f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0 ELSE {c} END AS {c}" for c in R.FEATURE_COLS)


@register("fill_feature_nulls", O.sql(DIRTY, f"SELECT account_id, {_FEATURE_FILL_SQL} FROM features"))
def fill_feature_nulls(spark, sf):
    return M.fill_feature_nulls(_dirty_features(spark, sf)).select("account_id", *R.FEATURE_COLS)


_DRS_COLS = "account_id, delinquency_30_days, delinquency_60_days, delinquency_90_days, delinquency_risk_score"


@register("delinquency_score", O.sql(FEAT, f"SELECT {_DRS_COLS} FROM features"))
def delinquency_score(spark, sf):
    return _features(spark, sf).select(*_DRS_COLS.split(", "))


@register("debt_stress", O.sql(FEAT, "SELECT account_id, debt_ratio, monthly_income, debt_stress FROM features"))
def debt_stress(spark, sf):
    return _features(spark, sf).select("account_id", "debt_ratio", "monthly_income", "debt_stress")


_FLAG_COLS = "account_id, credit_score, delinquency_risk_score, debt_ratio, high_risk_flag"


@register("high_risk_flag", O.sql(FEAT, f"SELECT {_FLAG_COLS} FROM features"))
def high_risk_flag(spark, sf):
    return _features(spark, sf).select(*_FLAG_COLS.split(", "))


@register("high_risk_flag_nulls", O.sql(DIRTY, f"SELECT {_FLAG_COLS}, debt_stress FROM features"))
def high_risk_flag_nulls(spark, sf):
    return _dirty_features(spark, sf).select(*_FLAG_COLS.split(", "), "debt_stress")


@register("label_cast", O.sql(FEAT, "SELECT account_id, CAST(serious_delinquency AS DOUBLE) AS serious_delinquency "
                                    "FROM features"))
def label_cast(spark, sf):
    return M.prepare_features(_features(spark, sf)).select("account_id", R.LABEL_COL)


@register("run_metadata", O.sql(SCORED, "SELECT account_id, model_version, scored_at FROM scored"))
def run_metadata(spark, sf):
    return _pinned(spark, sf).select("account_id", "model_version", "scored_at")


@register("scored_projection", O.sql(SCORED, f"SELECT {O.SCORED_PROJECTION} FROM scored"))
def scored_projection(spark, sf):
    return M.scored_projection(_pinned(spark, sf))


@register("conform_scored", O.sql(DIRTY + O.scored_ctes(), f"SELECT {O.SCORED_CONFORMED} FROM scored"))
def conform_scored(spark, sf):
    """Dirty inputs: NULL and NaN scores land in HIGH; DDL types."""
    return M.conform_scored(M.score_with_weights(_dirty_features(spark, sf), run_ts=RUN_TS))


_DDL_SQL = O.SCORED_CONFORMED.replace("AS debt_stress_score", "AS debt_stress")


@register("conform_scored_ddl", O.sql(SCORED, f"SELECT {_DDL_SQL} FROM scored"))
def conform_scored_ddl(spark, sf):
    """The names of the declared warehouse table."""
    return M.conform_scored(_pinned(spark, sf), schemas.DDL_NAMES)


@register("positive_probability_pinned", O.sql(SCORED, "SELECT account_id, risk_score AS score FROM scored"))
def positive_probability_pinned(spark, sf):
    """Element 1 of a probability vector, here built from the pinned score."""
    p = array_to_vector(F.array(1 - F.col("risk_score"), F.col("risk_score")))
    return _pinned(spark, sf).select("account_id", vector_to_array(p)[1].alias("score"))


@register("high_risk_sample", O.sql(FEAT, "SELECT account_id, credit_score, debt_ratio, delinquency_risk_score, "
                                          "high_risk_flag FROM features WHERE high_risk_flag = 1 "
                                          "ORDER BY account_id LIMIT 5"))
def high_risk_sample(spark, sf):
    return RP.high_risk_sample(_features(spark, sf), 5)


_CLIP_SQL = ("SELECT account_id, "
             "CASE WHEN credit_score IS NULL OR isnan(credit_score) THEN credit_score "
             "ELSE least(greatest(credit_score, 400), 800) END AS credit_score_clipped, "
             "CASE WHEN debt_ratio IS NULL OR isnan(debt_ratio) THEN debt_ratio "
             "ELSE least(greatest(debt_ratio, 5e-2), 6e-1) END AS debt_ratio_clipped "
             "FROM accounts_dirty")


@register("clip_columns", O.sql(BASE + [O.dirty_cte()], _CLIP_SQL))
def clip_columns(spark, sf):
    d = fx.dirty_accounts(_acc(spark, sf))
    return d.select("account_id", R.clip("credit_score", 400, 800).alias("credit_score_clipped"),
                    R.clip("debt_ratio", 0.05, 0.6).alias("debt_ratio_clipped"))


@register("round_truncate", "SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS price_units, "
                            "round(o_totalprice / 12, 4) AS installment_12 FROM orders")
def round_truncate(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").cast("int").alias("price_units"),
                    F.round(F.col("o_totalprice") / 12, 4).alias("installment_12"))


@register("open_date_text", O.sql(BASE, "SELECT account_id, account_open_date, "
                                        "strftime(DATE '2020-01-01' + CAST((" + O.KEY_NUMBER + " * 37) % 1461 AS INTEGER), "
                                        "'%Y-%m-%d') AS offset_open_date FROM accounts"))
def open_date_text(spark, sf):
    a = _acc(spark, sf)
    return a.select("account_id", "account_open_date",
                    R.date_text("2020-01-01", (fx.key_number() * 37) % 1461).alias("offset_open_date"))


# --- 2.4 filters -------------------------------------------------------------------------


@register("filter_high_risk", O.sql(FEAT, "SELECT * FROM features WHERE high_risk_flag = 1"))
def filter_high_risk(spark, sf):
    return FT.high_risk(_features(spark, sf))


_WRITTEN: dict[tuple[str, str], str] = {}


def _written_features(spark, sf) -> DataFrame:
    """The feature table, written once per application and staged input."""
    key = (app_id(spark), fx.stage_inputs(spark, sf)["accounts_table"])
    if key not in _WRITTEN:
        path = scratch_path(spark, "features")
        W.write_features(_features(spark, sf), path)
        _WRITTEN[key] = path
    return RD.read_features(spark, _WRITTEN[key])


@register("pruned_high_risk", O.sql(FEAT, "SELECT * FROM features WHERE high_risk_flag = 1"))
def pruned_high_risk(spark, sf):
    return _written_features(spark, sf).where(F.col("high_risk_flag") == 1)


@register("pruned_low_risk", O.sql(FEAT, "SELECT * FROM features WHERE high_risk_flag = 0"))
def pruned_low_risk(spark, sf):
    return _written_features(spark, sf).where(F.col("high_risk_flag") == 0)


_PRED_SQL = ("SELECT account_id, credit_score < 580 AS low_credit, delinquency_risk_score >= 3 AS delinquent, "
             "debt_ratio > 5e-1 AS high_debt, monthly_income < 5000 AS low_income, "
             "(credit_score < 580 OR delinquency_risk_score >= 3 OR debt_ratio > 5e-1) AS any_signal, "
             "(debt_ratio > 5e-1 AND monthly_income < 5000) AS stressed FROM features")


@register("predicate_nulls", O.sql(DIRTY, _PRED_SQL))
def predicate_nulls(spark, sf):
    r = R.DEFAULT_RULES
    f = _dirty_features(spark, sf)
    return f.select(
        "account_id",
        (F.col("credit_score") < r.credit_score_floor).alias("low_credit"),
        (F.col("delinquency_risk_score") >= r.delinquency_limit).alias("delinquent"),
        (F.col("debt_ratio") > r.debt_ratio_limit).alias("high_debt"),
        (F.col("monthly_income") < r.income_limit).alias("low_income"),
        R.high_risk_signals(r).alias("any_signal"),
        ((F.col("debt_ratio") > r.debt_ratio_limit) & (F.col("monthly_income") < r.income_limit)).alias("stressed"),
    )


# --- 2.2 sinks ---------------------------------------------------------------------------


@register("features_roundtrip", O.sql(FEAT, "SELECT * FROM features"))
def features_roundtrip(spark, sf):
    return _written_features(spark, sf)


@register("features_stream_roundtrip", O.sql(FEAT, "SELECT * FROM features"))
def features_stream_roundtrip(spark, sf):
    """The incremental feature job over the staged account files, read back."""
    from credit_signals.streaming.features import start_feature_stream
    paths = fx.stage_inputs(spark, sf)
    out = scratch_path(spark, "features-stream")
    q = start_feature_stream(spark, paths["accounts"], paths["bureau"], out)
    q.awaitTermination()
    return RD.read_features(spark, out)


@register("scored_table_roundtrip", O.sql(SCORED, f"SELECT {O.SCORED_CONFORMED} FROM scored"))
def scored_table_roundtrip(spark, sf):
    path = scratch_path(spark, "scored")
    W.write_scored(_pinned(spark, sf), path, by_day=False)
    return W.read_scored(spark, path, by_day=False)


@register("scored_by_day", O.sql(SCORED, "SELECT CAST(scored_at AS DATE) AS scored_date, count(*) AS accounts, "
                                         "count(*) FILTER (WHERE risk_band = 'HIGH') AS high_band "
                                         "FROM scored GROUP BY CAST(scored_at AS DATE)"))
def scored_by_day(spark, sf):
    path = scratch_path(spark, "scored-by-day")
    W.write_scored(_pinned(spark, sf), path, by_day=True)
    back = W.read_scored(spark, path, by_day=True)
    return back.groupBy(W.SCORED_PARTITION).agg(F.count(F.lit(1)).alias("accounts"),
                                                F.count_if(F.col("risk_band") == "HIGH").alias("high_band"))


@register("plain_parquet_roundtrip", O.sql(BASE, "SELECT * FROM accounts"))
def plain_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "accounts-copy")
    W.write_plain(_acc(spark, sf), path)
    return RD.read_accounts(spark, path)


@register("csv_sample_roundtrip", O.sql(BASE, "SELECT * FROM accounts ORDER BY account_id LIMIT 1000"))
def csv_sample_roundtrip(spark, sf):
    path = scratch_path(spark, "accounts-sample-csv")
    W.write_csv_sample(_acc(spark, sf), path, 1000)
    return W.read_csv(spark, path, schemas.ACCOUNTS)


# --- 2.6 model -----------------------------------------------------------------------------

_ASSEMBLED_SQL = "SELECT account_id, " + ", ".join(
    f"CAST(CASE WHEN {c} IS NULL OR isnan({c}) THEN 0 ELSE {c} END AS DOUBLE) AS {c}" for c in R.FEATURE_COLS
) + " FROM features"


@register("assembled_features", O.sql(FEAT, _ASSEMBLED_SQL))
def assembled_features(spark, sf):
    return M.unpack_features(M.prepare_features(_features(spark, sf)))


@register("hash_split", O.sql(FEAT, f"SELECT account_id, {O.HASH_BUCKET} AS bucket, "
                                    f"CASE WHEN {O.HASH_BUCKET} < 8 THEN 'train' ELSE 'test' END AS split "
                                    f"FROM features"))
def hash_split(spark, sf):
    return _features(spark, sf).select("account_id", R.hash_bucket("account_id").alias("bucket"),
                                       M.split_label().alias("split"))


@register("split_counts", O.sql(FEAT, f"SELECT CASE WHEN {O.HASH_BUCKET} < 8 THEN 'train' ELSE 'test' END AS split, "
                                      f"count(*) AS row_count FROM features GROUP BY 1"))
def split_counts(spark, sf):
    return _features(spark, sf).groupBy(M.split_label().alias("split")).agg(F.count(F.lit(1)).alias("row_count"))


NULL_KEYS = BASE + [O.null_key_cte("accounts", O.ACCOUNT_COLS, "acc_nk")]
_NK_SPLIT = f"CASE WHEN {O.HASH_BUCKET} < 8 THEN 'train' ELSE 'test' END"


@register("hash_split_null_keys", O.sql(NULL_KEYS, f"SELECT {_NK_SPLIT} AS split, count(*) AS row_count, "
                                                   "count(account_id) AS with_key FROM acc_nk GROUP BY 1"))
def hash_split_null_keys(spark, sf):
    """The two frames themselves: every row is in one of them, rows without a key in the test part."""
    train, test = M.hash_split(fx.null_keys(_acc(spark, sf)).select("account_id"))
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"), F.count("account_id").alias("with_key"))


@register("split_counts_null_keys", O.sql(NULL_KEYS, f"SELECT {_NK_SPLIT} AS split, count(*) AS row_count "
                                                     "FROM acc_nk GROUP BY 1"))
def split_counts_null_keys(spark, sf):
    return (fx.null_keys(_acc(spark, sf)).groupBy(M.split_label().alias("split"))
            .agg(F.count(F.lit(1)).alias("row_count")))


@register("score_pinned", O.sql(SCORED, "SELECT account_id, risk_score AS score FROM scored"))
def score_pinned(spark, sf):
    return _pinned(spark, sf).select("account_id", F.col("risk_score").alias("score"))


@register("risk_band", O.sql(SCORED, "SELECT account_id, risk_score AS score, risk_band FROM scored"))
def risk_band(spark, sf):
    return _pinned(spark, sf).select("account_id", F.col("risk_score").alias("score"), "risk_band")


@register("risk_band_counts", O.sql(SCORED, "SELECT risk_band, count(*) AS accounts FROM scored GROUP BY risk_band"))
def risk_band_counts(spark, sf):
    return _pinned(spark, sf).groupBy("risk_band").agg(F.count(F.lit(1)).alias("accounts"))


@register("auc_pinned", O.sql(SCORED + [O.grid_auc_sql("scored")], "SELECT auc FROM auc"))
def auc_pinned(spark, sf):
    return M.grid_auc(_pinned(spark, sf))


_MISSING = ("missing AS (SELECT risk_score, CASE WHEN " + O.KEY_NUMBER + " % 37 = 4 THEN NULL "
            "ELSE serious_delinquency END AS serious_delinquency FROM scored)")


@register("auc_missing_labels", O.sql(SCORED + [_MISSING, O.grid_auc_sql("missing")],
                                      "SELECT auc, (SELECT count(*) FROM missing WHERE serious_delinquency IS NULL) "
                                      "AS skipped_rows FROM auc"))
def auc_missing_labels(spark, sf):
    """Rows without a label take no part and are counted."""
    label = F.when(fx.key_number() % 37 == 4, F.lit(None)).otherwise(F.col(R.LABEL_COL))
    return M.grid_auc(_pinned(spark, sf).withColumn(R.LABEL_COL, label), report_skipped=True)


@register("model_verdict", O.sql(SCORED + [O.grid_auc_sql("scored")],
                                 "SELECT auc, CASE WHEN auc > 7e-1 THEN 'Good' ELSE 'Needs improvement' END AS verdict "
                                 "FROM auc"))
def model_verdict(spark, sf):
    auc = M.grid_auc(_pinned(spark, sf))
    return auc.select("auc", M.verdict(F.col("auc")).alias("verdict"))


@register("flagship_scored", O.sql(SCORED, f"SELECT {O.SCORED_CONFORMED} FROM scored"))
def flagship_scored(spark, sf):
    return M.conform_scored(_pinned(spark, sf))


# Fitted-model queries: Spark ML only, checked by rows and by tolerance tests.

_FITTED: dict[tuple[str, str], M.TrainResult] = {}


def _fitted(spark, sf) -> M.TrainResult:
    """One fit per application and staged input, shared by the model queries
    (as one fit serves evaluation and scoring in the scoring job).  Staged
    inputs never change under their key, so neither does the fit."""
    key = (app_id(spark), fx.stage_inputs(spark, sf)["accounts_table"])
    if key not in _FITTED:
        _FITTED[key] = M.train_model(M.prepare_features(_written_features(spark, sf)))
    return _FITTED[key]


def forget_fits() -> None:
    """Drop the fits and written tables that the queries share, so that a timing contains them."""
    _FITTED.clear()
    _WRITTEN.clear()


@register("model_coefficients")
def model_coefficients(spark, sf):
    return M.model_coefficients(spark, _fitted(spark, sf).model)


@register("model_auc")
def model_auc(spark, sf):
    res = _fitted(spark, sf)
    return spark.range(1).select(F.lit(res.auc).alias("auc"), F.lit(res.train_rows).alias("train_rows"),
                                 F.lit(res.test_rows).alias("test_rows"),
                                 M.verdict(F.lit(res.auc)).alias("verdict"))


@register("scored_accounts")
def scored_accounts(spark, sf):
    prepared = M.prepare_features(_features(spark, sf))
    return M.scored_projection(M.score_accounts(_fitted(spark, sf).model, prepared, run_ts=RUN_TS))


@register("positive_probability")
def positive_probability(spark, sf):
    prepared = M.prepare_features(_features(spark, sf))
    return (M.score_accounts(_fitted(spark, sf).model, prepared, run_ts=RUN_TS)
            .select("account_id", "risk_score", "prediction"))


@register("random_split_counts")
def random_split_counts(spark, sf):
    return (_written_features(spark, sf).groupBy(M.random_split_label().alias("split"))
            .agg(F.count(F.lit(1)).alias("row_count")))


@register("random_split_check", O.sql(FEAT, "SELECT count(*) AS total_rows, count(DISTINCT account_id) AS distinct_keys, "
                                            "0 AS keys_in_both, true AS near_share FROM features"))
def random_split_check(spark, sf):
    """The two parts hold all rows, share no key, and the train part has about its share (within five points)."""
    train, test = M.random_split(_written_features(spark, sf).select("account_id"))
    both = train.withColumn("t", F.lit(1)).unionByName(test.withColumn("t", F.lit(0)))
    keys = both.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    return keys.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"),
                    F.count_if((F.col("t") > 0) & (F.col("t") < F.col("n"))).alias("keys_in_both"),
                    (F.abs(F.sum("t") / F.sum("n") - 0.8) < 0.05).alias("near_share"))


@register("fitted_score_check", O.sql(FEAT, "SELECT count(*) AS total_rows, 0 AS differing, 0 AS outside_range, "
                                            "0 AS wrong_prediction FROM features"))
def fitted_score_check(spark, sf):
    """The fitted model's probability against the expression of its own weights, row by row."""
    model = _fitted(spark, sf).model
    scored = M.score_accounts(model, M.prepare_features(_written_features(spark, sf)), run_ts=RUN_TS)
    expected = M.LinearScore.from_model(model).probability()
    p = F.col("risk_score")
    return scored.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(~(F.abs(p - expected) <= 1e-9)).alias("differing"),
                      F.count_if(~p.between(0, 1)).alias("outside_range"),
                      F.count_if((p > 0.5) != (F.col("prediction") == 1)).alias("wrong_prediction"))


# --- 2.7 aggregations, reports, limits ---------------------------------------------------------


@register("feature_summary", O.sql(FEAT, "SELECT count(*) AS total_accounts, "
                                         "count(*) FILTER (WHERE high_risk_flag = 1) AS high_risk_accounts, "
                                         "CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE high_risk_flag = 1) "
                                         "AS DOUBLE) * 1e2 / count(*), 2) END AS high_risk_pct FROM features"))
def feature_summary(spark, sf):
    return RP.feature_summary(_features(spark, sf))


_VER_SQL = ("SELECT total_accounts, high_risk_accounts, "
            "CASE WHEN total_accounts > 0 THEN round(CAST(high_risk_accounts AS DOUBLE) * 1e2 / total_accounts, 1) END "
            "AS high_risk_pct, low_risk_accounts, "
            "CASE WHEN total_accounts > 0 THEN round(CAST(low_risk_accounts AS DOUBLE) * 1e2 / total_accounts, 1) END "
            "AS low_risk_pct FROM (SELECT count(*) AS total_accounts, "
            "count(*) FILTER (WHERE high_risk_flag = 1) AS high_risk_accounts, "
            "count(*) FILTER (WHERE high_risk_flag = 0) AS low_risk_accounts FROM features) t")


@register("verification_report", O.sql(FEAT, _VER_SQL))
def verification_report(spark, sf):
    return RP.verification_report(_written_features(spark, sf))


@register("default_rate", O.sql(BASE, "SELECT count(*) AS accounts, CAST(sum(serious_delinquency) AS BIGINT) AS defaults, "
                                      "avg(serious_delinquency) AS default_rate, "
                                      "CASE WHEN count(*) > 0 THEN round(CAST(sum(serious_delinquency) AS DOUBLE) * 1e2 "
                                      "/ count(*), 2) END AS default_rate_pct FROM accounts"))
def default_rate(spark, sf):
    return RP.default_rate(_acc(spark, sf))


@register("avg_credit_score", O.sql(BASE, "SELECT round(avg(credit_score), 0) AS avg_credit_score FROM accounts"))
def avg_credit_score(spark, sf):
    return RP.avg_credit_score(_acc(spark, sf))


@register("head_accounts", O.sql(BASE, "SELECT * FROM accounts ORDER BY account_id LIMIT 2"))
def head_accounts(spark, sf):
    return RP.head(_acc(spark, sf), 2)


# --- 2.8 rule prior --------------------------------------------------------------------------


@register("rule_default_prob", O.sql(BASE, f"SELECT account_id, {O.PRIOR_THOUSANDTHS} / 1e3 AS default_prob, "
                                           "serious_delinquency FROM accounts"))
def rule_default_prob(spark, sf):
    return _acc(spark, sf).select("account_id", R.rule_default_prob().alias("default_prob"), R.LABEL_COL)


_CAL_SQL = (f"SELECT default_prob, count(*) AS accounts, CAST(sum(serious_delinquency) AS BIGINT) AS defaults, "
            f"round(CAST(sum(serious_delinquency) AS DOUBLE) / count(*), 6) AS observed_rate "
            f"FROM (SELECT {O.PRIOR_THOUSANDTHS} / 1e3 AS default_prob, serious_delinquency FROM accounts) t "
            f"GROUP BY default_prob")


@register("rule_calibration", O.sql(BASE, _CAL_SQL))
def rule_calibration(spark, sf):
    return (_acc(spark, sf).groupBy(R.rule_default_prob().alias("default_prob"))
            .agg(F.count(F.lit(1)).alias("accounts"), F.sum(R.LABEL_COL).cast("long").alias("defaults"))
            .withColumn("observed_rate", F.round(F.col("defaults") / F.col("accounts"), 6)))


@register("expected_vs_observed", O.sql(BASE, f"SELECT round(CAST(sum({O.PRIOR_THOUSANDTHS}) AS DOUBLE) / (1e3 * count(*)), 6) "
                                              "AS expected_rate, round(CAST(sum(serious_delinquency) AS DOUBLE) / count(*), 6) "
                                              "AS observed_rate FROM accounts"))
def expected_vs_observed(spark, sf):
    a = _acc(spark, sf)
    sums = a.agg(F.sum(R.rule_prior_thousandths()).alias("prior"), F.sum(R.LABEL_COL).alias("labels"),
                 F.count(F.lit(1)).alias("n"))
    return sums.select(F.round(F.col("prior").cast("double") / (F.lit(1e3) * F.col("n")), 6).alias("expected_rate"),
                       F.round(F.col("labels").cast("double") / F.col("n"), 6).alias("observed_rate"))


# --- 2.9 run history ---------------------------------------------------------------------------

_RUN_COLS = ", ".join(schemas.RUN_LOG.fieldNames())


@register("runs_table", O.sql(RUNS, "SELECT * FROM runs"))
def runs_table(spark, sf):
    return _runs(spark, sf)


@register("runs_visible", O.sql(RUNS, f"SELECT * FROM runs WHERE submitted_by = {O.CURRENT_USER}"))
def runs_visible(spark, sf):
    runs = _runs(spark, sf)
    return RN.visible_runs(runs, _current_user(runs), is_staff=False)


@register("runs_newest", O.sql(RUNS, f"SELECT * FROM runs WHERE submitted_by = {O.CURRENT_USER} "
                                     "ORDER BY created_at DESC, job_id DESC"))
def runs_newest(spark, sf):
    runs = _runs(spark, sf)
    return RN.newest_first(RN.visible_runs(runs, _current_user(runs), is_staff=False))


@register("runs_page", O.sql(RUNS, "SELECT * FROM runs ORDER BY created_at DESC, job_id DESC LIMIT 20 OFFSET 20"))
def runs_page(spark, sf):
    return RN.page(_runs(spark, sf), 2)


@register("runs_projection", O.sql(RUNS, f"SELECT {', '.join(RN.PUBLIC_COLUMNS)} FROM runs "
                                         f"WHERE submitted_by = {O.CURRENT_USER}"))
def runs_projection(spark, sf):
    runs = _runs(spark, sf)
    return RN.project(RN.visible_runs(runs, _current_user(runs), is_staff=False), is_staff=False)


@register("runs_projection_staff", O.sql(RUNS, f"SELECT {', '.join(RN.STAFF_COLUMNS)} FROM runs"))
def runs_projection_staff(spark, sf):
    return RN.project(_runs(spark, sf), is_staff=True)


_OWNER_SQL = ", ".join("c.c_name AS submitted_by" if c == "submitted_by" else f"r.{c}"
                       for c in schemas.RUN_LOG.fieldNames())


@register("runs_owner_name", O.sql(RUNS, f"SELECT {_OWNER_SQL} FROM runs r LEFT JOIN customer c "
                                         f"ON r.submitted_by = c.c_custkey"))
def runs_owner_name(spark, sf):
    users = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                                   F.col("c_name").alias("username"))
    return RN.with_owner_name(_runs(spark, sf), users)


_REASON_SQL = ("nullif(concat_ws('; ', "
               "CASE WHEN status IS NULL OR status NOT IN ('PENDING', 'RUNNING', 'COMPLETED', 'FAILED') "
               "THEN 'invalid status' END, "
               "CASE WHEN job_type IS NULL OR job_type NOT IN ('feature_engineering', 'risk_scorer', 'batch_pipeline') "
               "THEN 'invalid job_type' END, "
               "CASE WHEN job_name IS NULL OR trim(job_name) = '' THEN 'missing job_name' END, "
               "CASE WHEN length(job_name) > 200 THEN 'job_name too long' END), '')")


@register("runs_valid", O.sql(RUNS, f"SELECT * FROM runs WHERE {_REASON_SQL} IS NULL"))
def runs_valid(spark, sf):
    return RN.valid_runs(_runs(spark, sf))


@register("runs_rejected", O.sql(RUNS, f"SELECT job_id, job_name, job_type, status, {_REASON_SQL} AS reason "
                                       f"FROM runs WHERE {_REASON_SQL} IS NOT NULL"))
def runs_rejected(spark, sf):
    return RN.rejected_runs(_runs(spark, sf))


_NAMELESS = ("nameless AS (SELECT * REPLACE (CASE WHEN job_id % 97 = 3 THEN NULL WHEN job_id % 101 = 5 THEN '' "
             "WHEN job_id % 103 = 7 THEN '  ' ELSE job_name END AS job_name) FROM runs)")


@register("runs_rejected_names", O.sql(RUNS + [_NAMELESS], f"SELECT job_id, job_name, job_type, status, {_REASON_SQL} AS reason "
                                                           f"FROM nameless WHERE {_REASON_SQL} IS NOT NULL"))
def runs_rejected_names(spark, sf):
    """Jobs without a name, or with a blank one, are rejected with a reason of their own."""
    j = F.col("job_id")
    name = (F.when(j % 97 == 3, F.lit(None).cast("string")).when(j % 101 == 5, F.lit("")).when(j % 103 == 7, F.lit("  "))
            .otherwise(F.col("job_name")))
    return RN.rejected_runs(_runs(spark, sf).withColumn("job_name", name))


_CURSOR = "(SELECT max(created_at) FROM runs WHERE status = 'FAILED')"
_CURSOR_ID = f"(SELECT max(job_id) FROM runs WHERE status = 'FAILED' AND created_at = {_CURSOR})"


@register("runs_after_cursor", O.sql(RUNS, f"SELECT * FROM runs WHERE created_at < {_CURSOR} OR (created_at = {_CURSOR} "
                                           f"AND job_id < {_CURSOR_ID}) ORDER BY created_at DESC, job_id DESC LIMIT 20"))
def runs_after_cursor(spark, sf):
    """The page after the newest failed job."""
    runs = _runs(spark, sf)
    at = runs.where(F.col("status") == "FAILED").agg(F.max(F.struct("created_at", "job_id")).alias("c")) \
        .select("c.*").first()                                       # the request's cursor, two literals
    return RN.page_after(runs, F.lit(at[0]).cast("timestamp_ntz"), at[1])


_OWNER_OF_FAILED = "(SELECT arg_max(submitted_by, job_id) FROM runs WHERE status = 'FAILED')"
_FAILED_ID = "(SELECT max(job_id) FROM runs WHERE status = 'FAILED')"


@register("run_lookup", O.sql(RUNS, f"SELECT * FROM runs WHERE submitted_by = {O.CURRENT_USER} "
                                    f"AND job_id = (SELECT max(job_id) FROM runs)"))
def run_lookup(spark, sf):
    runs = _runs(spark, sf)
    # the request's id and user, two literals from one scan
    newest, user = runs.agg(F.max("job_id"), F.max_by("submitted_by", "job_id")).first()
    return RN.lookup(runs, newest, user, is_staff=False)


_RETRY_SQL = ("SELECT job_id, job_name, job_type, submitted_by, "
              "CASE WHEN status = 'FAILED' THEN 'PENDING' ELSE status END AS status, created_at, "
              "CASE WHEN status = 'FAILED' THEN NULL ELSE started_at END AS started_at, "
              "CASE WHEN status = 'FAILED' THEN NULL ELSE completed_at END AS completed_at, gcs_output_path, "
              "CASE WHEN status = 'FAILED' THEN NULL ELSE error_message END AS error_message, dataproc_job_id "
              "FROM runs")


@register("runs_retry_reset", O.sql(RUNS, _RETRY_SQL))
def runs_retry_reset(spark, sf):
    return RN.retry_reset(_runs(spark, sf))


@register("run_retry", O.sql(RUNS, _RETRY_SQL + f" WHERE status = 'FAILED' AND submitted_by = {_OWNER_OF_FAILED} "
                                                f"AND job_id = {_FAILED_ID}"))
def run_retry(spark, sf):
    """One failed job of its submitter, reset."""
    runs = _runs(spark, sf)
    job, user = runs.where(F.col("status") == "FAILED").agg(F.max("job_id"), F.max_by("submitted_by", "job_id")).first()
    return RN.retry(runs, job, user, is_staff=False)


from credit_signals.plans import catalog_tables  # noqa: E402,F401 - registers its queries
