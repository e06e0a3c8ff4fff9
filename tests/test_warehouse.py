"""The warehouse connector, versioned tables, and counts taken while writing."""

import glob
import os
import subprocess
import sys

import pytest
from paths import SF001
from pyspark.sql import functions as F

from credit_signals import schemas
from credit_signals.operators import model as M
from credit_signals.plans import catalog, jobs
from credit_signals.sinks import manifest, warehouse
from credit_signals.sinks import writers as W
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_round_trip_and_rows(spark, tmp_path):
    scored = catalog._pinned(spark, SF001).repartition(5)
    path = str(tmp_path / "scored")
    written = W.write_scored(scored, path, fmt=warehouse.FORMAT)
    assert written == scored.count() == manifest.read(path).rows
    back = warehouse.read_table(spark, path)
    assert back.schema.fieldNames() == schemas.SCORED.fieldNames() and len(back.columns) == 11
    assert rows(back) == rows(M.conform_scored(scored))
    assert rows(spark.read.format(warehouse.FORMAT).load(path)) == rows(back)


def test_overwrite_append_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert warehouse.write_table(spark.range(10), path) == 10
    assert warehouse.write_table(spark.range(100, 103), path, mode="append") == 3
    assert warehouse.write_table(spark.range(7), path) == 7
    assert [manifest.read(path, n).rows for n in manifest.numbers(path)] == [10, 13, 7]
    assert rows(warehouse.read_table(spark, path, 2)) == [(i,) for i in sorted([*range(10), 100, 101, 102], key=lambda i: repr((i,)))]
    assert spark.read.format(warehouse.FORMAT).option("version", 1).load(path).count() == 10
    opened = warehouse.read_table(spark, path)
    assert manifest.remove_old(path, keep=1) == 2
    assert opened.count() == 7 and manifest.numbers(path) == [3]
    assert len(glob.glob(f"{path}/files/**/*.parquet", recursive=True)) == len(manifest.read(path).files)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert warehouse.write_table(spark.range(0), path) == 0
    assert warehouse.read_table(spark, path).schema == spark.range(0).schema and warehouse.read_table(spark, path).isEmpty()
    with pytest.raises(manifest.TableMissing):
        warehouse.read_table(spark, str(tmp_path / "none"))


def failing(df, column):
    """``df`` whose last partitions fail after the others have written."""
    return df.withColumn(column, F.when(F.col(column) >= 8, F.raise_error(F.lit("injected"))).otherwise(F.col(column)))


def test_a_failed_task_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    warehouse.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="injected"):
        warehouse.write_table(failing(spark.range(0, 10, 1, 5), "id"), path)
    assert manifest.numbers(path) == [1] and warehouse.read_table(spark, path).count() == 5
    assert len(glob.glob(f"{path}/files/**/*.parquet", recursive=True)) == len(manifest.read(path).files)


RETRY = """
import sys, os
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from credit_signals.sinks import manifest, warehouse

def once(batches):
    from pyspark import TaskContext
    for i, batch in enumerate(batches):
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost")

df = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long")
print("ROWS", warehouse.write_table(df, {path!r}), warehouse.read_table(spark, {path!r}).distinct().count(),
      len(manifest.read({path!r}).files))
"""


def test_a_retried_task_is_counted_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RETRY.format(root=root, path=str(tmp_path / "t"))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert "ROWS 1000 1000 4" in out.stdout, out.stderr[-2000:]
    assert len(glob.glob(f"{tmp_path}/t/files/**/*.parquet", recursive=True)) == 4


def test_publication_hides_a_failed_write(spark, tmp_path):
    table = str(tmp_path / "features")
    paths = fx.stage_inputs(spark, SF001)
    first = jobs.run_features(spark, paths["accounts_table"], paths["bureau_table"], table, publish=True)
    before = rows(RD.read_published_features(spark, table))
    assert len(before) == first.total_accounts == manifest.read(table).rows
    opened = RD.read_published_features(spark, table)
    broken = catalog._features(spark, SF001).withColumn(
        "age", F.when(F.col("age") > 60, F.raise_error(F.lit("injected"))).otherwise(F.col("age")))
    from credit_signals.session import observing_session
    with pytest.raises(Exception, match="injected"):
        W.publish_features(broken, table, None)
    assert observing_session(spark) is not spark
    assert rows(RD.read_published_features(spark, table)) == before == rows(opened)
    jobs.run_features(spark, paths["accounts_table"], paths["bureau_table"], table, publish=True)
    assert manifest.numbers(table) == [1, 2] and rows(opened) == before


def test_counts_come_from_the_write(spark, tmp_path):
    """One job group for the whole feature job, one scan of each input, and a later fit still serialises."""
    paths = fx.stage_inputs(spark, SF001)
    sc = spark.sparkContext
    sc.setJobGroup("feature-counts", "feature-counts")
    out = jobs.run_features(spark, paths["accounts_table"], paths["bureau_table"], str(tmp_path / "f"))
    done = len(sc.statusTracker().getJobIdsForGroup("feature-counts"))
    sc.setJobGroup("other", "other")
    plain = catalog.feature_summary(spark, SF001).first()
    assert (out.total_accounts, out.high_risk_accounts, out.high_risk_pct) == tuple(plain)
    assert (out.accounts_loaded, out.bureau_loaded) == (fx.accounts(spark, SF001).count(), fx.bureau(spark, SF001).count())
    assert done <= 3                     # the write (a broadcast and its stages), no counting job after it
    scored = jobs.run_scoring(spark, out.path, str(tmp_path / "s"), run_ts=catalog.RUN_TS)
    assert scored.written_rows == out.total_accounts == W.read_scored(spark, str(tmp_path / "s")).count()
    again = jobs.run_scoring(spark, out.path, str(tmp_path / "w"), fmt=warehouse.FORMAT, run_ts=catalog.RUN_TS)
    assert again.written_rows == out.total_accounts == manifest.read(str(tmp_path / "w")).rows


def test_counts_of_empty_inputs(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([], schemas.ACCOUNTS).write.parquet(a)
    spark.createDataFrame([], schemas.BUREAU).write.parquet(b)
    out = jobs.run_features(spark, a, b, str(tmp_path / "f"))
    assert (out.accounts_loaded, out.bureau_loaded, out.total_accounts, out.high_risk_pct) == (0, 0, 0, None)
