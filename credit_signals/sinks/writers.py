"""Writers.  Every write is an overwrite of a whole target (static mode drops
partitions that are not rewritten), done by Spark's commit protocol, so a
lost executor only re-runs its tasks."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals import schemas
from credit_signals.operators.model import conform_scored
from credit_signals.sinks import manifest, warehouse

FEATURE_PARTITION = "high_risk_flag"
SCORED_PARTITION = "scored_date"
FILE_FORMATS = frozenset({"parquet", "orc", "json", "csv"})


def write_features(df: DataFrame, path: str, mode: str = "overwrite", compact: bool = False) -> None:
    """Parquet, Hive layout on the flag, so readers of one flag prune the rest.

    By default no extra shuffle before the write: each task writes at most one
    file per flag value, so the file count is bounded by 2 x tasks.  With
    ``compact`` the rows are first rebalanced on the flag; adaptive execution
    cuts each flag's rows into advisory-size partitions, so files come out
    near that size (one full shuffle, for consumers that want fewer files).
    """
    out = df.hint("rebalance", FEATURE_PARTITION) if compact else df
    out.write.mode(mode).partitionBy(FEATURE_PARTITION).parquet(path)


def counted(df: DataFrame, **more) -> tuple[DataFrame, Observation]:
    """``df`` and counts that are taken while it is written: ``rows`` and the given aggregates.

    Only for a frame of ``session.observing_session``.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in more.items()]), seen


def observed(seen: Observation) -> dict:
    """The counts of ``counted``; none where the plan left out the counted part as known to be empty."""
    try:
        return seen.get
    except Py4JJavaError as error:               # such an observation has a row without a schema
        if "assertion failed" not in str(error.java_exception):
            raise
        return {}


def publish_features(df: DataFrame, table: str, rows: Observation, compact: bool = False) -> manifest.Manifest:
    """The feature table as the next version of ``table``: written beside the old one, then named by a manifest.

    Readers of ``readers.read_published_features`` see the old version until the
    one rename of the manifest, also while the write runs and when it fails.
    ``rows`` is the observation that came with ``df`` from ``counted``.
    """
    run = manifest.new_run()
    write_features(df, f"{table.rstrip('/')}/files/{run}", mode="errorifexists", compact=compact)
    return manifest.commit(table, df.schema.json(), [{"file": f"files/{run}", "rows": observed(rows).get("rows", 0)}])


def write_scored(scored: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None,
                 mode: str = "overwrite", by_day: bool | None = None, replace_days_only: bool = False,
                 names: dict[str, str] | None = None) -> int | None:
    """Conform to the warehouse schema and overwrite the target; the rows written, where the format tells them.

    ``credit_warehouse`` (``sinks.warehouse``) tells them from the commit messages
    of its tasks; other formats return None.

    ``fmt``/``options`` select any DataFrameWriter format (a warehouse
    connector on a cluster; Parquet by default).  A Parquet table is laid out
    by the day of ``scored_at`` (a 12th column, the folder); any other format
    gets exactly the 11 columns unless ``by_day`` asks for day folders of a file
    format - a connector partitions by its own options.  By default the whole
    table is replaced; ``replace_days_only`` replaces only the days being
    written (dynamic partition overwrite), so earlier runs' days stay.
    ``names`` renames target columns (``schemas.DDL_NAMES``).
    """
    by_day = fmt == "parquet" if by_day is None else by_day
    if by_day and fmt not in FILE_FORMATS:
        raise ValueError(f"day folders are for {sorted(FILE_FORMATS)}; pass {fmt!r} its own partition options")
    if replace_days_only and not by_day:
        raise ValueError("replace_days_only needs a table laid out by day")
    out = conform_scored(scored, names)
    if fmt == warehouse.FORMAT:
        if by_day:
            raise ValueError("the warehouse connector lays out its own files")
        return warehouse.write_table(out, target, mode, options)
    writer = out.withColumn(SCORED_PARTITION, F.to_date("scored_at")) if by_day else out
    opts = dict(options or {})
    if replace_days_only:
        opts["partitionOverwriteMode"] = "dynamic"
    w = writer.write.format(fmt).options(**opts).mode(mode)
    if by_day:
        w = w.partitionBy(SCORED_PARTITION)
    w.save(target)
    return None


def read_scored(spark: SparkSession, path: str, by_day: bool = True) -> DataFrame:
    schema = schemas.SCORED
    if by_day:
        schema = T.StructType(schema.fields + [T.StructField(SCORED_PARTITION, T.DateType())])
    return spark.read.schema(schema).parquet(path)


def write_plain(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Whole table, unpartitioned Parquet, no index column."""
    df.write.mode(mode).parquet(path)


def write_csv_sample(df: DataFrame, path: str, n: int = 1000, key: str = "account_id") -> None:
    """First ``n`` rows by key with a header line (a top-n, one small file)."""
    df.orderBy(F.col(key).asc_nulls_last()).limit(n).write.mode("overwrite") \
        .option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
