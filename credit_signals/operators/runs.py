"""Run-history questions over a job table (one row per job).

Filters, sorts, pages and projections; each is a plain DataFrame plan.  A page
is a top-k (``offset + limit`` over a sort), never a full sort to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the job table's domain.
# ---------------------------------------------------------------------------
STATUSES = ("PENDING", "RUNNING", "COMPLETED", "FAILED")
JOB_TYPES = ("feature_engineering", "risk_scorer", "batch_pipeline")
MAX_NAME_LENGTH = 200
PAGE_SIZE = 20
PUBLIC_COLUMNS = ("job_id", "job_name", "job_type", "submitted_by", "status", "created_at",
                  "started_at", "completed_at", "gcs_output_path")
STAFF_COLUMNS = PUBLIC_COLUMNS + ("error_message", "dataproc_job_id")
# ---------------------------------------------------------------------------


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def visible_runs(runs: DataFrame, user_id, is_staff: bool) -> DataFrame:
    """Staff see every row, anyone else only rows they submitted."""
    if is_staff:
        return runs
    return runs.where(F.col("submitted_by") == _lit(user_id))


def newest_first(runs: DataFrame) -> DataFrame:
    """Newest first; ``job_id`` breaks the many ties of ``created_at``."""
    return runs.orderBy(F.col("created_at").desc_nulls_last(), F.col("job_id").desc())


def page(runs: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    if number < 1:
        raise ValueError("pages start at 1")
    return newest_first(runs).offset(size * (number - 1)).limit(size)


def page_after(runs: DataFrame, created_at, job_id, size: int = PAGE_SIZE) -> DataFrame:
    """The page after the row (created_at, job_id), newest first.

    A cursor keeps every page a top-``size``, however deep; a page number makes
    one task hold all rows before it.  NULL times come last, by ``job_id``.
    """
    c, j = F.col("created_at"), F.col("job_id")
    if created_at is None:
        later = c.isNull() & (j < _lit(job_id))
    else:
        at = _lit(created_at)
        later = c.isNull() | (c < at) | ((c == at) & (j < _lit(job_id)))
    return newest_first(runs.where(later)).limit(size)


def project(runs: DataFrame, is_staff: bool) -> DataFrame:
    """9 public columns; staff also get the error message and batch id."""
    return runs.select(*(STAFF_COLUMNS if is_staff else PUBLIC_COLUMNS))


def with_owner_name(runs: DataFrame, users: DataFrame) -> DataFrame:
    """Owner key replaced by the user name; NULL when the user is gone.

    ``users`` is (user_id, username) with unique ids, so the left join never
    fans out; adaptive execution broadcasts it only when its runtime size is
    under the threshold, else sort-merges.
    """
    named = runs.join(users, runs["submitted_by"] == users["user_id"], "left")
    return named.select(*[F.col("username").alias("submitted_by") if c == "submitted_by" else runs[c]
                          for c in runs.columns])


def rejection_reason() -> Column:
    """Semicolon-joined list of failed domain checks, NULL when none fails."""
    reasons = F.concat_ws(
        "; ",
        F.when(~F.col("status").isin(*STATUSES) | F.col("status").isNull(), F.lit("invalid status")),
        F.when(~F.col("job_type").isin(*JOB_TYPES) | F.col("job_type").isNull(), F.lit("invalid job_type")),
        F.when(F.col("job_name").isNull() | (F.trim("job_name") == ""), F.lit("missing job_name")),
        F.when(F.length("job_name") > MAX_NAME_LENGTH, F.lit("job_name too long")),
    )
    return F.when(reasons != "", reasons)


def valid_runs(runs: DataFrame) -> DataFrame:
    return runs.where(rejection_reason().isNull())


def rejected_runs(runs: DataFrame) -> DataFrame:
    return runs.select("job_id", "job_name", "job_type", "status",
                       rejection_reason().alias("reason")).where(F.col("reason").isNotNull())


def lookup(runs: DataFrame, job_id, user_id, is_staff: bool) -> DataFrame:
    """One job by id, only if the caller may see it (else no row)."""
    return visible_runs(runs, user_id, is_staff).where(F.col("job_id") == _lit(job_id))


def retry(runs: DataFrame, job_id, user_id, is_staff: bool) -> DataFrame:
    """The reset row of one job the caller may see; no row if it is not FAILED."""
    return retry_reset(lookup(runs, job_id, user_id, is_staff).where(F.col("status") == "FAILED"))


def retry_reset(runs: DataFrame) -> DataFrame:
    """Set form, for operators: FAILED jobs back to PENDING with times and error cleared; others unchanged."""
    failed = F.col("status") == "FAILED"
    def cleared(c: str) -> Column:
        return F.when(failed, F.lit(None)).otherwise(F.col(c))
    return runs.withColumns({
        "status": F.when(failed, F.lit("PENDING")).otherwise(F.col("status")),
        "started_at": cleared("started_at"),
        "completed_at": cleared("completed_at"),
        "error_message": cleared("error_message"),
    })


# --- stored run tables ---------------------------------------------------------------

@dataclass(frozen=True)
class OrderedRuns:
    """A run table in newest-first order: files by range, and how many rows each range holds."""

    rows: str
    counts: str
    schema: T.StructType


def write_ordered(runs: DataFrame, path: str) -> OrderedRuns:
    """Write ``runs`` range partitioned in newest-first order, with the row count of each range beside it.

    Adaptive execution sizes the ranges; times are tied only up to ``job_id``, so
    no range is hot.  The counts come from the written files' footers.
    """
    spark = runs.sparkSession
    order = [F.col("created_at").desc_nulls_last(), F.col("job_id").desc()]
    table = OrderedRuns(f"{path}/rows", f"{path}/counts", runs.schema)
    runs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()) \
        .write.partitionBy("part").parquet(table.rows)
    _ordered(spark, table).groupBy("part").agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(table.counts)
    return table


def _ordered(spark: SparkSession, table: OrderedRuns) -> DataFrame:
    return spark.read.schema(T.StructType(table.schema.fields + [T.StructField("part", T.IntegerType())])).parquet(table.rows)


def page_of(spark: SparkSession, table: OrderedRuns, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` of an ordered table, however deep: only the ranges that hold it are read.

    The counts (one row per range) name them; a page spans more than one range
    only where a range ends inside it.  A page past the end is empty.
    """
    if number < 1:
        raise ValueError("pages start at 1")
    first = size * (number - 1)
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = spark.read.schema("part int, rows long").parquet(table.counts) \
        .withColumn("before", F.coalesce(F.sum("rows").over(upto), F.lit(0)))
    hold = at.where((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first)) \
        .orderBy("part").collect()                                      # at most ``size`` + 1 ranges
    rows = _ordered(spark, table).where(F.col("part").isin([r["part"] for r in hold])).drop("part")
    return newest_first(rows).offset(first - (hold[0]["before"] if hold else 0)).limit(size)


def write_lookup(runs: DataFrame, path: str, rows_per_group: int = 100_000) -> None:
    """Write ``runs`` sorted by ``job_id`` with a Bloom filter per row group, for ``lookup`` by id.

    An id reads one file by its row groups' ranges and, where ids are missing or
    ranges touch, one row group by its filter; the column index narrows to pages.
    """
    key = F.col("job_id")
    runs.repartitionByRange(key).sortWithinPartitions(key).write \
        .option("parquet.bloom.filter.enabled#job_id", "true") \
        .option("parquet.bloom.filter.expected.ndv#job_id", str(rows_per_group)) \
        .option("parquet.block.row.count.limit", str(rows_per_group)).parquet(path)


def write_checked(runs: DataFrame, path: str) -> None:
    """Accepted and rejected rows in one pass: one scan, one write, a folder for each with the reasons."""
    reason = rejection_reason()
    runs.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull()) \
        .write.partitionBy("accepted").parquet(path)


def read_accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The accepted rows that ``write_checked`` wrote (the other folder is not read)."""
    return _checked(spark, path, schema).where("accepted").select(*schema.fieldNames())


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected rows that ``write_checked`` wrote, with their reasons, as ``rejected_runs`` gives them."""
    return _checked(spark, path, schema).where("not accepted").select("job_id", "job_name", "job_type", "status", "reason")


def _checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField("reason", T.StringType()), T.StructField("accepted", T.BooleanType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)
