"""The incremental feature job equals the batch job, batch after batch."""

from pyspark.sql import functions as F

from paths import SF001
from credit_signals.operators.features import engineer_features
from credit_signals.session import scratch_path
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD
from credit_signals.streaming.features import start_feature_stream


def test_stream_in_two_arrivals_equals_batch(spark):
    paths = fx.stage_inputs(spark, SF001)
    accounts = fx.accounts(spark, SF001)
    incoming, out, ckpt = (scratch_path(spark, n) for n in ("t-in", "t-out", "t-ckpt"))
    first = accounts.where(fx.key_number() < 70)
    first.write.mode("append").parquet(incoming)
    q = start_feature_stream(spark, incoming, paths["bureau"], out, checkpoint=ckpt)
    q.awaitTermination()
    assert RD.read_features(spark, out).count() == 70
    accounts.where(fx.key_number() >= 70).write.mode("append").parquet(incoming)
    q = start_feature_stream(spark, incoming, paths["bureau"], out, checkpoint=ckpt)   # restart
    q.awaitTermination()
    got = RD.read_features(spark, out)
    want = engineer_features(accounts, fx.bureau(spark, SF001)).select(*got.columns)
    assert got.count() == 150 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.where(F.col("high_risk_flag") == 1).count() == 78


def test_stream_with_hot_bureau_keys_equals_batch(spark):
    from credit_signals.operators.features import derive_signals, fill_bureau_defaults
    from credit_signals.streaming.features import feature_stream
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = fx.stage_inputs(spark, SF001)
        dup_path = scratch_path(spark, "t-dup-bureau")
        fx.duplicated_bureau(fx.bureau(spark, SF001)).write.parquet(dup_path)
        stream = feature_stream(spark, paths["accounts"], dup_path, slice_rows=1)
        assert "Generate explode" in stream._jdf.queryExecution().analyzed().toString()   # hot keys split
        out, ckpt = scratch_path(spark, "t-hot-out"), scratch_path(spark, "t-hot-ckpt")
        q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .partitionBy("high_risk_flag").trigger(availableNow=True).start())
        q.awaitTermination()
        got = RD.read_features(spark, out)
        accounts = fx.accounts(spark, SF001)
        want = derive_signals(fill_bureau_defaults(
            accounts.join(spark.read.parquet(dup_path), "account_id", "left"))).select(*got.columns)
        assert got.count() == 153 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
