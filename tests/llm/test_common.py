from pyspark.sql import functions as F

from credit_signals.llm.common import materialise


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_materialise_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = shuffle_files(spark), spark.conf.get(setting)
    frame = spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).count()
    table = materialise(frame, "cleanup-test")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(setting) == kept
    # the frame and the table can be used again
    assert frame.agg(F.sum("count")).first()[0] == table.agg(F.sum("count")).first()[0] == 20_000
    assert materialise(frame, "cleanup-test").count() == 5_000
