"""Run-history questions on the orders-as-run-log fixture."""

from pyspark.sql import functions as F

from paths import SF001
from credit_signals.operators import runs as RN
from credit_signals.sources import fixtures as fx


def test_pages_are_disjoint_and_newest_first(spark):
    runs = fx.run_log(spark, SF001)
    p1 = [(r.created_at, r.job_id) for r in RN.page(runs, 1).collect()]
    p2 = [(r.created_at, r.job_id) for r in RN.page(runs, 2).collect()]
    assert len(p1) == len(p2) == 20 and not set(p1) & set(p2)
    both = p1 + p2
    assert both == sorted(both, reverse=True)
    newest = runs.orderBy(F.desc("created_at"), F.desc("job_id")).first()
    assert p1[0] == (newest.created_at, newest.job_id)


def test_visibility_and_lookup(spark):
    runs = fx.run_log(spark, SF001)
    assert RN.visible_runs(runs, 7, is_staff=True).count() == runs.count()
    own = RN.visible_runs(runs, 7, is_staff=False)
    assert own.where(F.col("submitted_by") != 7).count() == 0
    other = runs.where(F.col("submitted_by") != 7).first().job_id
    assert RN.lookup(runs, other, 7, is_staff=False).count() == 0
    assert RN.lookup(runs, other, 7, is_staff=True).count() == 1


def test_projection_by_role(spark):
    runs = fx.run_log(spark, SF001)
    assert len(RN.project(runs, False).columns) == 9 and len(RN.project(runs, True).columns) == 11


def test_retry_resets_only_failed(spark):
    runs = fx.run_log(spark, SF001)
    after = RN.retry_reset(runs)
    assert after.where(F.col("status") == "FAILED").count() == 0
    unchanged = runs.where(F.col("status") != "FAILED")
    assert unchanged.exceptAll(after.join(unchanged.select("job_id"), "job_id", "left_semi")
                               .select(*runs.columns)).count() == 0
    reset = after.join(runs.where(F.col("status") == "FAILED").select("job_id"), "job_id", "left_semi")
    assert reset.where(F.col("started_at").isNotNull() | F.col("error_message").isNotNull()).count() == 0


def test_rejections_have_reasons(spark):
    runs = fx.run_log(spark, SF001)
    rejected = RN.rejected_runs(runs)
    reasons = {r.reason for r in rejected.select("reason").distinct().collect()}
    assert reasons <= {"invalid status", "invalid job_type", "invalid status; invalid job_type"}
    assert rejected.count() + RN.valid_runs(runs).count() == runs.count() == 1500


def test_owner_name_is_null_when_user_is_gone(spark):
    runs = fx.run_log(spark, SF001)
    users = (fx.table(spark, SF001, "customer").where(F.col("c_custkey") % 2 == 0)    # odd users deleted
             .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username")))
    named = RN.with_owner_name(runs, users)
    assert named.count() == runs.count() and named.columns == runs.columns
    orphan = runs.where(F.col("submitted_by") % 2 == 1).count()
    assert named.where(F.col("submitted_by").isNull()).count() == orphan > 0
