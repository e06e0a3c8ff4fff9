"""Left outer equi-join on one key, safe against hot keys on either side.

Semantics are those of ``left.join(right, key, "left")``: every left row is
kept, duplicate right keys fan out, a NULL key matches nothing, and the output
is the key, then the left columns, then the right columns.

NULL keys.  Rows without a key match nothing, so they stay out of the join and
get NULL right columns; otherwise all of them would meet in one task.

Hot keys.  Every partition summarises the hashes of its keys by a fixed number of
counters (the least of them is taken off all when there are more), and summaries
merge in a tree.  A counter is too low by at most what was taken off, so no key
above ``slice_rows`` is missed; the few candidates are then counted exactly, with
a map-side combine.  A key with more than ``slice_rows`` rows is hot; there are
at most rows / ``slice_rows`` of them, and they stay in a table (written once,
broadcast up to ``BROADCAST_BYTES``).  Rows of other keys take the plain join - on bucketed
inputs with no exchange at all.  Rows of hot keys are split in a grid: the left
rows of key k in ``L_k`` slices, the right rows in ``R_k`` slices
(``ceil(n / slice_rows)`` each, 1 where k is not hot); each left slice is
repeated for the right slices and vice versa, so each of the ``L_k x R_k``
tasks sees about ``slice_rows`` rows per side.  Adaptive execution cannot do
this: it splits no right side of a left join, and no join of co-bucketed inputs.

The rows of a side that is split are written once below the shared folder, and
a row's slice comes from its place in the file.  A retried task finds the same
slices, exact copies spread like any rows, and no row is grouped, so every
column type passes through as it is.  Where the right side is split, a key hot
there was seen in the right table, so a left replica without a match in its
slice is dropped; otherwise every left row has one replica and stays.

Both ways give the plain join's rows, so the choice between them (no hot key; a
right side that Spark broadcasts) changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals.session import scratch_path

DEFAULT_SLICE_ROWS = 1_000_000
COUNTERS = 16_384                # of one summary
MERGED_TOGETHER = 256            # summaries that one task merges
BROADCAST_BYTES = 64 << 20       # of the table of hot keys
_SUMMARY = "node int, h long, n long"


def _reduced(h: np.ndarray, n: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts per distinct hash, at most ``counters`` of them, and what was taken off each."""
    h, back = np.unique(h, return_inverse=True)
    total = np.zeros(h.size, np.int64)
    np.add.at(total, back, n)
    if h.size <= counters:
        return h, total, 0
    off = int(np.partition(total, h.size - counters - 1)[h.size - counters - 1])
    left = total > off
    return h[left], total[left] - off, off


def key_summary(df: DataFrame, key: str, counters: int = COUNTERS, together: int = MERGED_TOGETHER) -> DataFrame:
    """(h, n) of the frequent key hashes of ``df``; one row without h holds the error bound.

    The true count of a hash is between n and n + error, and that of an absent
    one at most error, which is at most rows / (counters + 1).  NULL keys are left out.
    """
    import pyspark.cloudpickle as cloudpickle
    import sys
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = pa.schema([("node", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])

    def table(node: int, h: np.ndarray, n: np.ndarray, error: int) -> pa.Table:
        return pa.table([np.full(h.size + 1, node, np.int32), pa.array([*h.tolist(), None], pa.int64()),
                         np.append(n, error)], schema=schema)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n, error = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            h, n, off = _reduced(np.concatenate((h, seen.field("values").to_numpy(zero_copy_only=False))),
                                 np.concatenate((n, seen.field("counts").to_numpy(zero_copy_only=False))), counters)
            error += off
        yield from table(TaskContext.get().partitionId(), h, n, error).to_batches()

    def merge(some: pa.Table) -> pa.Table:
        bound = pc.is_null(some.column("h"))
        errors, counts = some.filter(bound), some.filter(pc.invert(bound))
        h, n, off = _reduced(counts.column("h").to_numpy(), counts.column("n").to_numpy(), counters)
        return table(some.column("node")[0].as_py(), h, n, off + (pc.sum(errors.column("n")).as_py() or 0))

    hashes = df.where(F.col(key).isNotNull()).select(F.xxhash64(F.col(key)).alias("h"))
    parts = hashes.mapInArrow(summarise, _SUMMARY)
    for node in (F.floor(F.col("node") / together), F.lit(0)):
        parts = parts.withColumn("node", node.cast("int")).groupBy("node").applyInArrow(merge, _SUMMARY)
    return parts.select("h", "n")


def hot_keys(df: DataFrame, key: str, slice_rows: int = DEFAULT_SLICE_ROWS, counters: int = COUNTERS) -> DataFrame:
    """(k, slices) of exactly the keys of ``df`` with more than ``slice_rows`` rows.

    If the error of a summary reaches a slice, it is taken again with as many
    counters as rule that out.
    """
    summary = _written(key_summary(df, key, counters), "key-summary")
    error, counted = summary.agg(F.max(F.when(F.col("h").isNull(), F.col("n"))),
                                 F.sum(F.when(F.col("h").isNotNull(), F.col("n")))).first()
    error = error or 0
    if error >= slice_rows:
        rows = df.where(F.col(key).isNotNull()).count()
        summary = _written(key_summary(df, key, 2 * rows // slice_rows + 1), "key-summary")
        error = summary.where("h is null").agg(F.max("n")).first()[0] or 0
    candidates = summary.where(F.col("h").isNotNull() & (F.col("n") + F.lit(error) > slice_rows)).select("h")
    rows = df.select(F.col(key).alias("k")).where("k is not null").withColumn("h", F.xxhash64("k"))
    return (rows.join(F.broadcast(candidates), "h").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > slice_rows).select("k", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices")))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (what the planner compares with the
    broadcast threshold); None when unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate: treat as large
        return None


def _threshold_bytes(df: DataFrame) -> int:
    raw = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def broadcast_planned(df: DataFrame) -> bool:
    threshold = _threshold_bytes(df)
    size = estimated_bytes(df)
    return threshold >= 0 and size is not None and size <= threshold


def left_join(left: DataFrame, right: DataFrame, key: str, *, skew_guard: bool = True,
              slice_rows: int = DEFAULT_SLICE_ROWS, always_split: bool = False) -> DataFrame:
    """``left LEFT JOIN right USING (key)``; see the module notes for skew.

    ``skew_guard=False`` is for inputs whose keys are known to be unique: they
    are not summarised.  ``always_split`` looks for hot keys also where Spark
    would broadcast the right side.
    """
    if slice_rows < 1:
        raise ValueError("slice_rows must be positive")
    if not skew_guard or (broadcast_planned(right) and not always_split):
        return left.join(right, key, "left")
    on_right = hot_keys(right, key, slice_rows).withColumnRenamed("slices", "rs")
    if left.isStreaming:                         # a stream cannot be summarised; its keys stay in one slice
        hot = on_right.withColumn("ls", F.lit(1))
    else:
        on_left = hot_keys(left, key, slice_rows).withColumnRenamed("slices", "ls")
        hot = on_left.join(on_right, "k", "full")
    hot = _written(hot.select("k", F.coalesce("ls", F.lit(1)).alias("ls"), F.coalesce("rs", F.lit(1)).alias("rs")),
                   "hot-keys")
    if hot.isEmpty():
        return _around_null_keys(left, right, key, lambda rows: rows.join(right, key, "left"))
    return split_left_join(left, right, key, hot)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _around_null_keys(left: DataFrame, right: DataFrame, key: str, join) -> DataFrame:
    """``join`` of the rows with a key, then the rows without one and NULL right columns."""
    if left.isStreaming or not left.schema[key].nullable:
        return join(left)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    others = [F.col(c) for c in left.columns if c != key]
    return join(left.where(F.col(key).isNotNull())).union(left.where(F.col(key).isNull()).select(key, *others, *nothing))


def _sliced(df: DataFrame, key: str, hot: DataFrame, slices: str, split: bool) -> DataFrame:
    """(k, row, ls, rs, at) of the hot rows; ``at`` is the row's slice, from its place in a written file."""
    rows = df.select(F.col(key).alias("k"), F.struct(*[F.col(c) for c in df.columns]).alias("row")).join(hot, "k")
    if not split:
        return rows.withColumn("at", F.lit(0))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return _written(rows, "hot-rows").select("k", "row", "ls", "rs", F.pmod(place, F.col(slices)).cast("int").alias("at"))


def _repeat(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def split_left_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | list[tuple]) -> DataFrame:
    """The plain left join, with the rows of ``hot`` keys (k, ls, rs) joined on a salted grid.

    Keys never cross branches, so the union is exact.  Precondition (met by
    ``left_join``, which counts right slices in the right table): a
    key with more than one right slice occurs in the right table.
    """
    if isinstance(hot, list):
        kind = T.StructType([T.StructField("k", left.schema[key].dataType), T.StructField("ls", T.IntegerType()),
                             T.StructField("rs", T.IntegerType())])
        hot = left.sparkSession.createDataFrame(hot, kind)
    size = F.sum(F.lit(32) + F.octet_length(F.to_json(F.struct("k"))))       # keys can be long
    size, split_left, split_right = hot.agg(size, F.max("ls") > 1, F.max("rs") > 1).first()
    hot = F.broadcast(hot) if (size or 0) <= BROADCAST_BYTES else hot
    names = hot.select(F.col("k").alias(key))
    left_cols = [c for c in left.columns if c != key]
    right_cols = [c for c in right.columns if c != key]

    def grid(rows: DataFrame) -> DataFrame:
        cold = rows.join(names, key, "left_anti").join(right.join(names, key, "left_anti"), key, "left")
        lq = _sliced(rows, key, hot, "ls", bool(split_left)).withColumn("rj", _repeat("rs")).alias("l")
        rq = _sliced(right, key, hot, "rs", bool(split_right)).withColumn("lj", _repeat("ls")).alias("r")
        pairs = lq.join(rq, (F.col("l.k") == F.col("r.k")) & (F.col("l.at") == F.col("r.lj"))
                        & (F.col("l.rj") == F.col("r.at")), "left")
        kept = pairs.where((F.col("l.rs") == 1) | F.col("r.k").isNotNull())
        warm = kept.select(F.col("l.row").getField(key).alias(key),
                           *[F.col("l.row").getField(c).alias(c) for c in left_cols],
                           *[F.col("r.row").getField(c).alias(c) for c in right_cols])
        return cold.union(warm)

    return _around_null_keys(left, right, key, grid)
