"""Deep pages, point lookups and the checked write over stored run tables."""

import datetime as dt

import pytest
from paths import SF001
from pyspark.sql import functions as F

from credit_signals import schemas
from credit_signals.operators import runs as RN
from credit_signals.sources import fixtures as fx


@pytest.fixture(scope="module")
def runs(spark):
    odd = [(9_000_001, "no time", "risk_scorer", 1, "PENDING", None, None, None, None, None, None),
           (9_000_000, None, "risk_scorer", None, "LOST", None, None, None, None, None, None)]
    return fx.run_log(spark, SF001).unionByName(spark.createDataFrame(odd, schemas.RUN_LOG)).cache()


def scan_metric(df, name="numOutputRows"):
    """The rows that the file scans of an executed frame gave out, and the partition folders they read."""
    df._jdf.queryExecution().assertAnalyzed()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    todo, out = [plan], []
    while todo:
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getSimpleName():
            out.append(node.metrics().apply(name).value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_every_page_by_number(spark, runs, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = RN.write_ordered(runs, str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = [r.job_id for r in RN.newest_first(runs).collect()]
    parts = spark.read.parquet(table.counts).count()
    assert parts > 2
    for number in (1, 2, 17, len(want) // 97, len(want) // 97 + 1, len(want) // 97 + 2):
        page = RN.page_of(spark, table, number, size=97)
        assert [r.job_id for r in page.collect()] == want[97 * (number - 1):97 * number]
        assert page.columns == runs.columns
    with pytest.raises(ValueError):
        RN.page_of(spark, table, 0)


def test_a_page_reads_the_ranges_that_hold_it(spark, runs, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = RN.write_ordered(runs, str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    counts = [r["rows"] for r in spark.read.parquet(table.counts).orderBy("part").collect()]
    read = scan_metric(RN.page_of(spark, table, 1))
    assert read and max(read) <= counts[0] + (counts[1] if counts[0] < RN.PAGE_SIZE else 0) < sum(counts)


def test_empty_run_table(spark, tmp_path):
    table = RN.write_ordered(spark.createDataFrame([], schemas.RUN_LOG), str(tmp_path / "r"))
    assert RN.page_of(spark, table, 1).count() == 0


def test_lookup_reads_one_row_group(spark, runs, tmp_path):
    path = str(tmp_path / "by-id")
    RN.write_lookup(runs, path, rows_per_group=100)
    stored = spark.read.schema(schemas.RUN_LOG).parquet(path)
    assert stored.count() == runs.count()
    some = runs.where("submitted_by is not null").orderBy(F.md5(F.col("job_id").cast("string"))).limit(3).collect()
    for r in some:
        found = RN.lookup(stored, r.job_id, None, is_staff=True)
        assert [tuple(x) for x in found.collect()] == [tuple(r)]
        assert max(scan_metric(RN.lookup(stored, r.job_id, None, is_staff=True))) <= 100
    absent = RN.lookup(stored, some[0].job_id + 10_000_000, None, is_staff=True)
    assert absent.count() == 0 and max(scan_metric(absent), default=0) == 0


def test_a_missing_id_inside_the_range_is_told_by_the_filter(spark, tmp_path):
    import pyarrow.parquet as pq
    import glob
    even = spark.range(0, 4000, 2).select(
        F.col("id").alias("job_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RUN_LOG.fields[1:]])
    path = str(tmp_path / "even")
    RN.write_lookup(even, path, rows_per_group=500)
    assert max(scan_metric(RN.lookup(spark.read.schema(schemas.RUN_LOG).parquet(path), 2001, None, is_staff=True))) == 0
    groups = [pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(f"{path}/*.parquet")]
    assert sum(groups) >= 4


def test_checked_write(spark, runs, tmp_path):
    path = str(tmp_path / "checked")
    sc = spark.sparkContext
    sc.setJobGroup("checked", "checked")
    RN.write_checked(runs, path)
    assert len(sc.statusTracker().getJobIdsForGroup("checked")) == 1
    sc.setJobGroup("other", "other")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)

    assert rows(RN.read_accepted(spark, path, runs.schema)) == rows(RN.valid_runs(runs))
    assert rows(RN.read_rejected(spark, path, runs.schema)) == rows(RN.rejected_runs(runs))
    plan = RN.read_rejected(spark, path, runs.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan


def test_times_survive(spark, runs, tmp_path):
    table = RN.write_ordered(runs, str(tmp_path / "r"))
    first = RN.page_of(spark, table, 1).first()
    assert isinstance(first.created_at, dt.datetime) and first.created_at == runs.agg(F.max("created_at")).first()[0]
