"""Independent SQL (DuckDB dialect) for every oracle-checked query.

Written from the fixture rules, not generated from the Spark plans: the
driver tables are views named like the Parquet files.  Float literals are
written in exponent form (``5e-1``) so they are doubles, integer sums are cast
to BIGINT, and NaN is tested with ``isnan`` because ``coalesce`` keeps it.
"""

from __future__ import annotations

from credit_signals import schemas

RUN_TS = "2001-11-05 12:00:00"

_ORD = """ord AS (
  SELECT o_custkey AS k,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS tot,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS f,
         CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS p,
         count(*) AS n,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u,
         count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-02-01') AS inq,
         min(o_orderdate) AS first_order
  FROM orders GROUP BY o_custkey)"""

_LIN = """lin AS (
  SELECT o_custkey AS k,
         count(*) FILTER (WHERE d BETWEEN 30 AND 59) AS d30,
         count(*) FILTER (WHERE d BETWEEN 60 AND 74) AS d60,
         count(*) FILTER (WHERE d BETWEEN 90 AND 97) AS d90,
         count(*) FILTER (WHERE d BETWEEN 98 AND 107) AS t90,
         count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-08-05') AS coll
  FROM (SELECT o_custkey, l_returnflag, l_shipdate,
               date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
  GROUP BY o_custkey)"""

_PROFILE = """profile AS (
  SELECT c.c_custkey AS k, c.c_acctbal,
         coalesce(tot, 0) AS tot, coalesce(f, 0) AS f, coalesce(p, 0) AS p, coalesce(n, 0) AS n,
         coalesce(u, 0) AS u, coalesce(inq, 0) AS inq, first_order,
         coalesce(d30, 0) AS d30, coalesce(d60, 0) AS d60, coalesce(d90, 0) AS d90,
         coalesce(t90, 0) AS t90, coalesce(coll, 0) AS coll
  FROM customer c LEFT JOIN ord ON ord.k = c.c_custkey LEFT JOIN lin ON lin.k = c.c_custkey)"""

def int32(x: str) -> str:
    """A 32-bit integer; a value beyond its range becomes the nearest end, NULL stays NULL."""
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(least(2147483647, greatest(-2147483648, {x})) AS INTEGER) END"


_ACC0 = f"""acc0 AS (
  SELECT concat('A', repeat('0', greatest(0, 9 - length(CAST(k AS VARCHAR)))), CAST(k AS VARCHAR)) AS account_id,
         CAST(least(850, greatest(300, 500 + CAST(floor(c_acctbal * 4e-2) AS INTEGER))) AS INTEGER) AS credit_score,
         {int32('floor(tot / 48000)')} AS monthly_income,
         {int32('floor(greatest(c_acctbal, 0e0))')} AS balance,
         CASE WHEN tot = 0 THEN 1e-2
              ELSE least(99e-2, greatest(1e-2, CAST(floor(f * 10000 / tot) AS DOUBLE) / 1e4)) END AS debt_ratio,
         {int32('d30')} AS delinquency_30_days,
         {int32('d60')} AS delinquency_60_days,
         {int32('d90')} AS delinquency_90_days,
         {int32('n')} AS open_credit_lines,
         CAST(k % 6 AS INTEGER) AS dependents,
         CAST(18 + (k * 7) % 62 AS INTEGER) AS age,
         {int32('t90')} AS times_90_days_late,
         {int32('u')} AS real_estate_loans,
         (k * 7919 + 17) % 1000 AS draw,
         strftime(first_order, '%Y-%m-%d') AS account_open_date
  FROM profile)"""

PRIOR_THOUSANDTHS = ("(50 + CASE WHEN credit_score < 580 THEN 150 ELSE 0 END"
                     " + CASE WHEN debt_ratio > 5e-1 THEN 100 ELSE 0 END"
                     " + CASE WHEN delinquency_90_days > 0 THEN 80 ELSE 0 END"
                     " + CASE WHEN times_90_days_late > 0 THEN 50 ELSE 0 END)")

_ACCOUNTS = f"""accounts AS (
  SELECT account_id, credit_score, monthly_income, balance, debt_ratio,
         delinquency_30_days, delinquency_60_days, delinquency_90_days, open_credit_lines,
         dependents, age, times_90_days_late, real_estate_loans,
         CAST(CASE WHEN draw < {PRIOR_THOUSANDTHS} THEN 1 ELSE 0 END AS INTEGER) AS serious_delinquency,
         account_open_date
  FROM acc0)"""

_BUREAU = f"""bureau AS (
  SELECT concat('A', repeat('0', greatest(0, 9 - length(CAST(k AS VARCHAR)))), CAST(k AS VARCHAR)) AS account_id,
         CAST(500 + (k * 6151) % 350 AS INTEGER) AS bureau_score,
         {int32('inq')} AS inquiries_last_6mo,
         {int32('coll')} AS collections_last_12mo,
         CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS public_records,
         CASE WHEN tot = 0 THEN 0e0 ELSE CAST(floor(p * 10000 / tot) AS DOUBLE) / 1e4 END AS revolving_utilization,
         '2001-11-05' AS bureau_updated_date
  FROM profile WHERE k % 10 <> 0)"""

KEY_NUMBER = "CAST(substr(account_id, 2) AS BIGINT)"

ACCOUNT_COLS = schemas.ACCOUNTS.fieldNames()
BUREAU_COLS = schemas.BUREAU.fieldNames()


def _select(cols, overrides=None) -> str:
    overrides = overrides or {}
    return ", ".join(f"{overrides[c]} AS {c}" if c in overrides else c for c in cols)


def base_ctes() -> list[str]:
    return [_ORD, _LIN, _PROFILE, _ACC0, _ACCOUNTS, _BUREAU]


def dirty_cte(src: str = "accounts", name: str = "accounts_dirty") -> str:
    over = {
        "credit_score": "CASE WHEN i % 29 = 5 THEN NULL ELSE credit_score END",
        "debt_ratio": ("CASE WHEN i % 23 = 7 THEN CAST('NaN' AS DOUBLE) WHEN i % 31 = 9 THEN NULL "
                       "ELSE debt_ratio END"),
        "delinquency_30_days": "CASE WHEN i % 17 = 3 THEN NULL ELSE delinquency_30_days END",
    }
    return (f"{name} AS (SELECT {_select(ACCOUNT_COLS, over)} "
            f"FROM (SELECT *, {KEY_NUMBER} AS i FROM {src}) s)")


def bureau_dup_cte(src: str = "bureau", name: str = "bureau_dup") -> str:
    return (f"{name} AS (SELECT * FROM {src} UNION ALL "
            f"SELECT * FROM {src} WHERE {KEY_NUMBER} % 50 = 1)")


def null_key_cte(src: str, cols, name: str) -> str:
    over = {"account_id": f"CASE WHEN {KEY_NUMBER} % 41 = 2 THEN NULL ELSE account_id END"}
    return f"{name} AS (SELECT {_select(cols, over)} FROM {src})"


BUREAU_FILL = {
    "bureau_score": "coalesce(bureau_score, 0)",
    "revolving_utilization": ("CASE WHEN revolving_utilization IS NULL OR isnan(revolving_utilization) "
                              "THEN 0e0 ELSE revolving_utilization END"),
    "inquiries_last_6mo": "coalesce(inquiries_last_6mo, 0)",
}

DRS = "delinquency_90_days * 3 + delinquency_60_days * 2 + delinquency_30_days * 1"
STRESS = "CASE WHEN debt_ratio > 5e-1 AND monthly_income < 5000 THEN 1 ELSE 0 END"
FLAG = ("CASE WHEN credit_score < 580 OR delinquency_risk_score >= 3 OR debt_ratio > 5e-1 "
        "THEN 1 ELSE 0 END")


def joined_cte(acc: str = "accounts", bur: str = "bureau", name: str = "joined") -> str:
    return f"{name} AS (SELECT * FROM {acc} LEFT JOIN {bur} USING (account_id))"


def features_ctes(acc: str = "accounts", bur: str = "bureau", name: str = "features") -> list[str]:
    cols = ACCOUNT_COLS + BUREAU_COLS[1:]
    return [
        joined_cte(acc, bur, f"{name}_j"),
        f"{name}_f AS (SELECT {_select(cols, BUREAU_FILL)} FROM {name}_j)",
        f"{name}_d AS (SELECT *, {DRS} AS delinquency_risk_score FROM {name}_f)",
        f"{name} AS (SELECT *, {STRESS} AS debt_stress, {FLAG} AS high_risk_flag FROM {name}_d)",
    ]


PINNED_SCORE = ("round(1e0 / (1e0 + exp(-(-6e-3 * (credit_score - 600) + 3e0 * (debt_ratio - 35e-2)"
                " + 15e-2 * delinquency_risk_score + 5e-1 * debt_stress))), 6)")


def band(score: str = "risk_score") -> str:
    return (f"CASE WHEN {score} <= 3e-1 THEN 'LOW' WHEN {score} > 3e-1 AND {score} <= 6e-1 "
            f"THEN 'MEDIUM' ELSE 'HIGH' END")


def scored_ctes(src: str = "features", name: str = "scored") -> list[str]:
    return [
        f"{name}_s AS (SELECT *, {PINNED_SCORE} AS risk_score FROM {src})",
        f"{name} AS (SELECT *, {band()} AS risk_band, '1.0.0' AS model_version, "
        f"TIMESTAMP '{RUN_TS}' AS scored_at FROM {name}_s)",
    ]


SCORED_PROJECTION = ("account_id, risk_score AS score, risk_band, scored_at, model_version, "
                     "delinquency_risk_score, debt_stress AS debt_stress_score, high_risk_flag, "
                     "credit_score, debt_ratio, monthly_income")

SCORED_CONFORMED = ("account_id, CAST(risk_score AS DOUBLE) AS score, risk_band, scored_at, model_version, "
                    "CAST(delinquency_risk_score AS DOUBLE) AS delinquency_risk_score, "
                    "CAST(debt_stress AS BIGINT) AS debt_stress_score, "
                    "CAST(high_risk_flag AS BIGINT) AS high_risk_flag, "
                    "CAST(credit_score AS BIGINT) AS credit_score, CAST(debt_ratio AS DOUBLE) AS debt_ratio, "
                    "CAST(monthly_income AS BIGINT) AS monthly_income")

HASH_BUCKET = "CAST(('0x' || substr(md5(account_id), 1, 8)) AS BIGINT) % 10"


def grid_auc_sql(src: str, score: str = "risk_score", label: str = "serious_delinquency") -> str:
    return f"""cells AS (
  SELECT floor({score} * 1e4) AS cell, count(*) FILTER (WHERE {label} = 1) AS pos,
         count(*) FILTER (WHERE {label} = 0) AS neg
  FROM {src} WHERE {score} IS NOT NULL AND NOT isnan({score}) AND {label} IN (0, 1) GROUP BY floor({score} * 1e4)),
ranked AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS neg_below FROM cells),
totals AS (
  SELECT CAST(sum(pos * (neg_below * 2 + neg)) AS BIGINT) AS num2, CAST(sum(pos) AS BIGINT) AS p,
         CAST(sum(neg) AS BIGINT) AS n FROM ranked),
auc AS (
  SELECT CASE WHEN 2e0 * CAST(p AS DOUBLE) * CAST(n AS DOUBLE) > 0
              THEN round(CAST(num2 AS DOUBLE) / (2e0 * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)), 6) END AS auc
  FROM totals)"""


_RUNS = """runs0 AS (
  SELECT o_orderkey AS job_id, concat('job-', CAST(o_orderkey AS VARCHAR)) AS job_name,
         CASE o_orderkey % 4 WHEN 0 THEN 'feature_engineering' WHEN 1 THEN 'risk_scorer'
              WHEN 2 THEN 'batch_pipeline' ELSE 'other' END AS job_type,
         o_custkey AS submitted_by,
         CASE WHEN o_orderstatus = 'F' THEN 'FAILED' WHEN o_orderstatus = 'O' THEN 'RUNNING'
              WHEN o_orderkey % 3 = 0 THEN 'PENDING' WHEN o_orderkey % 50 = 1 THEN 'CANCELLED'
              ELSE 'COMPLETED' END AS status,
         o_orderdate AS created_at
  FROM orders),
runs AS (
  SELECT job_id, job_name, job_type, submitted_by, status, created_at,
         CASE WHEN status <> 'PENDING' THEN created_at END AS started_at,
         CASE WHEN status IN ('COMPLETED', 'FAILED') THEN created_at + to_hours(CAST(job_id % 5 + 1 AS BIGINT)) END
           AS completed_at,
         CASE WHEN status = 'COMPLETED' THEN concat('features/', job_type, '/', CAST(job_id AS VARCHAR)) END
           AS gcs_output_path,
         CASE WHEN status = 'FAILED' THEN concat('batch failed: job ', CAST(job_id AS VARCHAR)) END AS error_message,
         CASE WHEN status <> 'PENDING' THEN concat('batch-', CAST(job_id AS VARCHAR)) END AS dataproc_job_id
  FROM runs0)"""


def runs_ctes() -> list[str]:
    return [_RUNS]


CURRENT_USER = "(SELECT arg_max(submitted_by, job_id) FROM runs)"


def sql(ctes: list[str], body: str) -> str:
    seen, out = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return ("WITH " + ",\n".join(out) + "\n" + body) if out else body
