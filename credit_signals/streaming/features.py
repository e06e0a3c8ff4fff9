"""The feature job over a growing folder of account files.

Each micro-batch of new account files is left-joined with the static bureau
table (stream-static join, stream on the left as the join requires), filled,
derived with the same rule expressions as the batch job, and appended to the
flag-partitioned Parquet table.  The file sink plus the checkpoint under the
shared folder make the output exactly-once across restarts and lost executors.
No state is kept: every row is final when its batch commits.  Hot bureau keys
are found once on the static side and their rows split over salt slices, so a
key holding a third of the bureau does not make one straggler per batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from credit_signals import schemas
from credit_signals.functions.rules import DEFAULT_RULES, RiskRules
from credit_signals.operators.features import derive_signals, fill_bureau_defaults
from credit_signals.operators.joins import left_join
from credit_signals.session import scratch_path
from credit_signals.sinks.writers import FEATURE_PARTITION
from credit_signals.sources.readers import read_bureau


def feature_stream(spark: SparkSession, accounts_dir: str, bureau_path: str,
                   rules: RiskRules = DEFAULT_RULES, max_files_per_trigger: int | None = None,
                   **join_opts) -> DataFrame:
    # files are read with their own types (64-bit integers too) and cast, as the batch reader does
    try:
        found = spark.read.parquet(accounts_dir).schema
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        found = schemas.ACCOUNTS
    reader = spark.readStream.schema(found)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    accounts = schemas.conform(reader.parquet(accounts_dir), schemas.ACCOUNTS)
    # hot bureau keys (found once on the static side) are split over salt slices
    joined = left_join(accounts, read_bureau(spark, bureau_path), "account_id", **join_opts)
    return derive_signals(fill_bureau_defaults(joined), rules)


def start_feature_stream(spark: SparkSession, accounts_dir: str, bureau_path: str, out_path: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         processing_time: str | None = None, **opts) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    writer = (feature_stream(spark, accounts_dir, bureau_path, **opts).writeStream
              .format("parquet").outputMode("append")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "features-stream-ckpt"))
              .partitionBy(FEATURE_PARTITION))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
