"""Session creation and the shared scratch location.

On a cluster ``spark.checkpoint.dir`` names a shared folder; every table this
library materialises (staged inputs, sink round trips) goes below it.  A local
default is only set when the session has none, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app_name: str = "credit-signals", master: str | None = None,
            shuffle_partitions: int | None = None,
            extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session; ``master`` defaults to the launcher's."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of Parquet.

    Scan splits of 512 MB keep the task count near input / 512 MB (200k tasks
    for 100 TB, about 25 waves on 8,000 cores).  The initial shuffle partition
    count aims at ~256 MB per partition (never below two per core); adaptive
    execution then coalesces small ones to the advisory size and splits skewed
    ones, so every partition fits in executor memory with room to spill.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local context
        return None


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (keys the per-application caches)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else str(spark.conf.get("spark.app.id", "remote"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised tables.

    Reads ``SparkContext.getCheckpointDir()`` or ``spark.checkpoint.dir``; only
    when both are unset (local runs) a folder is created and registered.  A
    remote session must name the folder in ``spark.checkpoint.dir``.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return str(configured)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="credit-signals-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (never reused, never cleared)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/credit_signals/{name}-{uuid.uuid4().hex[:12]}"


def observing_session(spark: SparkSession) -> SparkSession:
    """A session of the same application, with the same settings, for jobs whose counts are observed.

    An ``Observation`` leaves a manager in its session that closures of Spark ML,
    which carry the session, cannot be serialised with.  In a session of its own
    it stays out of their way; tables of the shared catalog are visible in both.
    """
    work = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if work.conf.isModifiable(key) and work.conf.get(key, None) != value:
            work.conf.set(key, value)
    return work


def file_state(spark: SparkSession, paths: dict[str, str]) -> dict[str, tuple]:
    """{name: (files, bytes, digest of all names, sizes and times)} of files or folders, listed by Spark.

    No file is opened.  A path in any store that Spark reads will do.
    """
    from pyspark.sql import functions as F
    out = {}
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.lit(name).alias("name"), "path", "length", "modificationTime") for name, path in paths.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    entry = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(20,0)")
    for row in every.groupBy("name").agg(F.count(F.lit(1)), F.sum("length"), F.sum(entry)).collect():   # one row per name
        out[row[0]] = (row[1], row[2], str(row[3]))
    return {name: out.get(name, (0, 0, "")) for name in paths}


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for tools that want a plain path."""
    return path[len("file:"):] if path.startswith("file:") else path

