"""Queries over stored tables and over sums that prove a result: registered beside ``catalog``.

The warehouse connector and versioned tables, the ordered and the indexed run
table, the checked write, the first step of the fit, the exact AUC, and the
nested schema tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_signals.functions import rules as R
from credit_signals.operators import model as M
from credit_signals.operators import runs as RN
from credit_signals.plans import catalog as C
from credit_signals.plans import oracle as O
from credit_signals.session import app_id, observing_session, scratch_path
from credit_signals.sinks import manifest, warehouse
from credit_signals.sinks import writers as W
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD

register = C.register

# --- connector write, publication -----------------------------------------------------


@register("scored_connector_roundtrip", O.sql(C.SCORED, f"SELECT {O.SCORED_CONFORMED} FROM scored"))
def scored_connector_roundtrip(spark, sf):
    """11 columns through the warehouse connector and back."""
    path = scratch_path(spark, "scored-warehouse")
    W.write_scored(C._pinned(spark, sf), path, fmt=warehouse.FORMAT)
    return warehouse.read_table(spark, path)


@register("scored_connector_versions", O.sql(C.SCORED, "SELECT v AS version, CASE v WHEN 1 THEN low WHEN 2 THEN total ELSE high "
                                                       "END AS table_rows FROM (SELECT count(*) AS total, "
                                                       "count(*) FILTER (WHERE risk_band = 'LOW') AS low, "
                                                       "count(*) FILTER (WHERE risk_band = 'HIGH') AS high FROM scored) t, "
                                                       "(VALUES (1), (2), (3)) AS n(v)"))
def scored_connector_versions(spark, sf):
    """Rows of three versions by their commit messages: the LOW band, the others appended, the HIGH band alone."""
    path = scratch_path(spark, "scored-versions")
    scored = C._pinned(spark, sf)
    W.write_scored(scored.where(F.col("risk_band") == "LOW"), path, fmt=warehouse.FORMAT)
    W.write_scored(scored.where(F.col("risk_band") != "LOW"), path, fmt=warehouse.FORMAT, mode="append")
    W.write_scored(scored.where(F.col("risk_band") == "HIGH"), path, fmt=warehouse.FORMAT)
    rows = [(n, manifest.read(path, n).rows) for n in manifest.numbers(path)]
    return spark.createDataFrame(rows, "version int, table_rows long")


@register("features_published", O.sql(C.FEAT, "SELECT * FROM features"))
def features_published(spark, sf):
    """The feature table as a version named by its manifest."""
    from credit_signals.plans import jobs
    paths = fx.stage_inputs(spark, sf)
    table = scratch_path(spark, "features-published")
    jobs.run_features(spark, paths["accounts_table"], paths["bureau_table"], table, publish=True)
    return RD.read_published_features(spark, table)


@register("counts_in_flight", O.sql(C.FEAT, "SELECT (SELECT count(*) FROM accounts) AS accounts_loaded, "
                                            "(SELECT count(*) FROM bureau) AS bureau_loaded, count(*) AS total_accounts, "
                                            "count(*) FILTER (WHERE high_risk_flag = 1) AS high_risk_accounts FROM features"))
def counts_in_flight(spark, sf):
    """The feature job's counts, taken while it reads and writes."""
    from credit_signals.plans import jobs
    paths = fx.stage_inputs(spark, sf)
    r = jobs.run_features(spark, paths["accounts_table"], paths["bureau_table"], scratch_path(spark, "features-counted"))
    return spark.createDataFrame([(r.accounts_loaded, r.bureau_loaded, r.total_accounts, r.high_risk_accounts)],
                                 "accounts_loaded long, bureau_loaded long, total_accounts long, high_risk_accounts long")


# --- the fit ---------------------------------------------------------------------------

_TERMS = ["one", *R.FEATURE_COLS, "label"]


def _term_sql(c: str) -> str:
    if c == "one":
        return "1::HUGEINT AS one"
    if c == "label":
        return "serious_delinquency::HUGEINT AS label"
    filled = f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0 ELSE {c} END"
    unit = M.FEATURE_UNITS.get(c, 1)
    return f"CAST(round({filled} * {unit}) AS HUGEINT) AS {c}"


_MOMENTS_SQL = " UNION ALL ".join(
    f"SELECT split, '{a}' AS a, '{b}' AS b, CAST(sum({a} * {b}) AS VARCHAR) AS total FROM terms GROUP BY split"
    for i, a in enumerate(_TERMS) for b in _TERMS[i:])


@register("fit_first_step", O.sql(C.FEAT + [f"terms AS (SELECT CASE WHEN {O.HASH_BUCKET} < 8 THEN 'train' ELSE 'test' END AS split, "
                                            + ", ".join(map(_term_sql, _TERMS)) + " FROM features)"], _MOMENTS_SQL))
def fit_first_step(spark, sf):
    """The exact sums of which the first Newton step of the fit is made, per split."""
    sums = M.moment_sums(C._features(spark, sf), M.split_label())
    return sums.select("split", "a", "b", F.col("total").cast("string").alias("total"))


@register("fit_losses")
def fit_losses(spark, sf):
    """Mean log loss on both splits: zero weights, one Newton step, the fit (tested: each below the one before)."""
    features = C._written_features(spark, sf)
    step = M.newton_step(M.moment_sums(features, M.split_label()), "train")
    fitted = M.LinearScore.from_model(C._fitted(spark, sf).model)
    zero = M.LinearScore(tuple((c, 0.0, None) for c in R.FEATURE_COLS), 0.0, None)
    scores = {"zero_loss": zero, "step_loss": step, "fitted_loss": fitted}
    parts = [M.log_losses(part, scores).select(F.lit(name).alias("split"), "*")
             for name, part in zip(("train", "test"), M.hash_split(features))]
    return parts[0].unionByName(parts[1])


_EXACT_AUC = ("SELECT round(sum(pos * (2 * below + neg))::DOUBLE / (2e0 * sum(pos)::DOUBLE * sum(neg)::DOUBLE), 12) AS auc, "
              "sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY risk_score "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT risk_score, "
              "count(*) FILTER (WHERE serious_delinquency = 1) AS pos, count(*) FILTER (WHERE serious_delinquency = 0) AS neg "
              "FROM scored GROUP BY risk_score) c) r")


@register("auc_exact", O.sql(C.SCORED, _EXACT_AUC))
def auc_exact(spark, sf):
    """Area under ROC over the scores themselves, ranked in ranges."""
    return M.exact_auc(C._pinned(spark, sf))


# --- stored run tables --------------------------------------------------------------------

_STORED: dict[tuple, object] = {}


def _stored(spark, sf, name, write):
    """A run table, written once per application, folder and state of its files."""
    from credit_signals.session import file_state
    at = (app_id(spark), sf, name, file_state(spark, {"orders": f"{sf.rstrip('/')}/orders.parquet"})["orders"])
    if at not in _STORED:
        path = scratch_path(spark, name)
        _STORED[at] = (path, write(C._runs(spark, sf), path))
    return _STORED[at]


_DEEP = "(SELECT count(*) // 20 - 1 FROM runs)"          # the page before the last full one


@register("runs_page_deep", O.sql(C.RUNS, "SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (ORDER BY created_at DESC "
                                          f"NULLS LAST, job_id DESC) AS place FROM runs) r WHERE place > 20 * ({_DEEP} - 1) "
                                          f"AND place <= 20 * {_DEEP}"))
def runs_page_deep(spark, sf):
    """A page near the end by its number: only the range that holds it is read."""
    _, table = _stored(spark, sf, "runs-ordered", RN.write_ordered)
    total = spark.read.schema("part int, rows long").parquet(table.counts).agg(F.sum("rows")).first()[0]
    return RN.page_of(spark, table, max(1, total // 20 - 1))


@register("run_lookup_indexed", O.sql(C.RUNS, f"SELECT * FROM runs WHERE submitted_by = {O.CURRENT_USER} "
                                              "AND job_id = (SELECT max(job_id) FROM runs)"))
def run_lookup_indexed(spark, sf):
    """One job by id from the table sorted and filtered by it."""
    path, _ = _stored(spark, sf, "runs-by-id", RN.write_lookup)
    stored = spark.read.schema(C._runs(spark, sf).schema).parquet(path)
    newest, user = stored.agg(F.max("job_id"), F.max_by("submitted_by", "job_id")).first()
    return RN.lookup(stored, newest, user, is_staff=False)


def _checked(spark, sf) -> tuple[str, object]:
    path, _ = _stored(spark, sf, "runs-checked", RN.write_checked)
    return path, C._runs(spark, sf).schema


@register("runs_accepted_stored", O.sql(C.RUNS, f"SELECT * FROM runs WHERE {C._REASON_SQL} IS NULL"))
def runs_accepted_stored(spark, sf):
    """The accepted half of the one checked write."""
    return RN.read_accepted(spark, *_checked(spark, sf))


@register("runs_rejected_stored", O.sql(C.RUNS, f"SELECT job_id, job_name, job_type, status, {C._REASON_SQL} AS reason "
                                                f"FROM runs WHERE {C._REASON_SQL} IS NOT NULL"))
def runs_rejected_stored(spark, sf):
    """The rejected half of the one checked write, with its reasons."""
    return RN.read_rejected(spark, *_checked(spark, sf))


# --- integers, schema tree ---------------------------------------------------------------

_FAR = "(o_orderkey - 300) * 20000000"


@register("int_saturation", f"SELECT o_orderkey, {O.int32(_FAR)} AS bounded FROM orders")
def int_saturation(spark, sf):
    """The rule for derived integers: beyond 32 bits they become the nearest end."""
    far = (F.col("o_orderkey") - 300) * 20_000_000
    return fx.table(spark, sf, "orders").select("o_orderkey", fx.to_int(far).alias("bounded"))


def nested_orders(orders: DataFrame) -> DataFrame:
    """Orders of a customer as an array of structs, with totals by status as a map."""
    return orders.groupBy("o_custkey").agg(
        F.collect_list(F.struct("o_orderkey", F.struct("o_orderdate", "o_orderstatus").alias("state"))).alias("orders"),
        F.map_from_entries(F.collect_set(F.struct("o_orderstatus", F.lit(1.0)))).alias("by_status"))


_NESTED_SQL = """
WITH nested AS (SELECT o_custkey, list({'o_orderkey': o_orderkey, 'state': {'o_orderdate': o_orderdate, 'o_orderstatus': o_orderstatus}}) AS orders,
                       map_from_entries(list(DISTINCT {'k': o_orderstatus, 'v': 1.0::DOUBLE})) AS by_status FROM orders GROUP BY o_custkey),
     one AS (SELECT * FROM nested LIMIT 1),
     t AS (SELECT 1 AS p, 'o_custkey' AS path, 0 AS depth, typeof(o_custkey) AS ty FROM one
           UNION ALL SELECT 2, 'orders', 0, left(typeof(orders), 0) || CASE WHEN typeof(orders) LIKE '%[]' THEN 'array' END FROM one
           UNION ALL SELECT 3, 'orders.element', 1, CASE WHEN typeof(orders[1]) LIKE 'STRUCT%' THEN 'struct' END FROM one
           UNION ALL SELECT 4, 'orders.element.o_orderkey', 2, typeof(orders[1].o_orderkey) FROM one
           UNION ALL SELECT 5, 'orders.element.state', 2, CASE WHEN typeof(orders[1].state) LIKE 'STRUCT%' THEN 'struct' END FROM one
           UNION ALL SELECT 6, 'orders.element.state.o_orderdate', 3, typeof(orders[1].state.o_orderdate) FROM one
           UNION ALL SELECT 7, 'orders.element.state.o_orderstatus', 3, typeof(orders[1].state.o_orderstatus) FROM one
           UNION ALL SELECT 8, 'by_status', 0, CASE WHEN typeof(by_status) LIKE 'MAP%' THEN 'map' END FROM one
           UNION ALL SELECT 9, 'by_status.key', 1, typeof(map_keys(by_status)[1]) FROM one
           UNION ALL SELECT 10, 'by_status.value', 1, typeof(map_values(by_status)[1]) FROM one)
SELECT p AS position, path, depth, CASE ty """ + C._TYPES_SQL + """ ELSE ty END AS data_type FROM t
"""


@register("schema_tree", _NESTED_SQL)
def schema_tree(spark, sf):
    """Every node of a nested table derived from the orders."""
    nested = nested_orders(fx.table(spark, sf, "orders"))
    return RD.schema_tree(nested).drop("nullable")
