"""Declared table schemas and conformance to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Column names, order and types of the tables that users already
# have; results must carry exactly these.
# ---------------------------------------------------------------------------
ACCOUNTS = _struct(
    ("account_id", _S), ("credit_score", _I), ("monthly_income", _I), ("balance", _I),
    ("debt_ratio", _D), ("delinquency_30_days", _I), ("delinquency_60_days", _I),
    ("delinquency_90_days", _I), ("open_credit_lines", _I), ("dependents", _I), ("age", _I),
    ("times_90_days_late", _I), ("real_estate_loans", _I), ("serious_delinquency", _I),
    ("account_open_date", _S),
)

BUREAU = _struct(
    ("account_id", _S), ("bureau_score", _I), ("inquiries_last_6mo", _I),
    ("collections_last_12mo", _I), ("public_records", _I), ("revolving_utilization", _D),
    ("bureau_updated_date", _S),
)

DERIVED = _struct(("delinquency_risk_score", _I), ("debt_stress", _I), ("high_risk_flag", _I))

# key, 14 account columns, 6 bureau columns, 3 derived columns (flag last).
FEATURES = T.StructType(ACCOUNTS.fields + BUREAU.fields[1:] + DERIVED.fields)

# Warehouse table (STRING / FLOAT64 / INTEGER / TIMESTAMP).
SCORED = _struct(
    ("account_id", _S), ("score", _D), ("risk_band", _S), ("scored_at", T.TimestampType()),
    ("model_version", _S), ("delinquency_risk_score", _D), ("debt_stress_score", _L),
    ("high_risk_flag", _L), ("credit_score", _L), ("debt_ratio", _D), ("monthly_income", _L),
)

# Fixed value: the declared warehouse table names one column differently.
DDL_NAMES = {"debt_stress_score": "debt_stress"}

# Fixed value: where the scored frame's columns come from, for the 11-column projection.
SCORED_SOURCES = {"score": "risk_score", "debt_stress_score": "debt_stress"}

RUN_LOG = _struct(
    ("job_id", _L), ("job_name", _S), ("job_type", _S), ("submitted_by", _L), ("status", _S),
    ("created_at", T.TimestampNTZType()), ("started_at", T.TimestampNTZType()),
    ("completed_at", T.TimestampNTZType()), ("gcs_output_path", _S), ("error_message", _S),
    ("dataproc_job_id", _S),
)


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, sources: dict[str, str] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, order and types.

    ``sources`` maps a target name to a differently named input column.  A
    missing input column raises ``SchemaMismatch`` instead of a silent NULL.
    """
    sources = sources or {}
    current = df.schema
    if not sources and [(f.name, f.dataType) for f in current.fields] == \
            [(f.name, f.dataType) for f in schema.fields]:
        return df                     # already conformed: no extra projection to analyse
    have = set(current.fieldNames())
    cols: list[Column] = []
    missing = []
    for field in schema.fields:
        src = sources.get(field.name, field.name)
        if src not in have:
            missing.append(src)
            continue
        cols.append(F.col(src).cast(field.dataType).alias(field.name))
    if missing:
        raise SchemaMismatch(f"missing column(s) for the target schema: {missing}")
    return df.select(*cols)
