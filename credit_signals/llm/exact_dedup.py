"""Exact duplicates by mergeable counting quotient filters.

1. Every text gets a 64-bit fingerprint of its normalised bytes.
2. Each partition builds a counting quotient filter: the leading bits of a
   fingerprint are the quotient, the others the remainder; a quotient's run
   holds its remainders in ascending order with counts.  Runs of one quotient
   merge without loss by merging the sorted remainders and adding the counts.
3. Fingerprints whose merged count is above one go on to byte verification:
   the normalised bytes themselves are grouped.  All other rows are alone.

A copied text is summed in its partition's filter and in the map side of every
aggregation, so a group of a third of all rows is a few rows per partition
after the first step.  The text of a row is shuffled only if its fingerprint
repeats.  ``routing_bits`` bounds the bitmap that tells a scan which texts to
send on; a full bitmap sends more of them and changes no result.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_chosen, materialise, ship, utf8

SPACE = b" \t\n\x0b\x0c\r"
RUN_ENTRIES = 1 << 16            # fingerprints that a merged run holds on average
PARTITION_ENTRIES = 1 << 21      # fingerprints per filter; a larger partition writes several


def _normalised(text: bytes) -> bytes:
    # ASCII white space never occurs inside a multi-byte UTF-8 sequence
    return text.translate(None, SPACE)


_DIGEST = T.StructType([T.StructField("points", T.LongType()), T.StructField("fp", T.LongType()),
                        T.StructField("sha", T.StringType())])


def _digest(texts: pa.Array) -> pa.Array:
    points, fps, shas = [], [], []
    for b in utf8(texts):
        n = _normalised(b)
        points.append(len(b.decode("utf-8", "replace")))
        fps.append(xxhash.xxh3_64_intdigest(n))
        shas.append(hashlib.sha256(n).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(points, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(shas, pa.string())],
        names=["points", "fp", "sha"])


def digest(text: Column) -> Column:
    """struct(points, fp, sha): code points, 64-bit fingerprint and SHA-256 of the normalised text."""
    return F.arrow_udf(_digest, _DIGEST)(text)


def _runs(fps: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """A counting quotient filter, one row per quotient that occurs."""
    shift = np.uint64(64 - bits)
    order = np.argsort(fps, kind="stable")
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], fps[1:] != fps[:-1]))) if fps.size else np.array([], int)
    fps, counts = fps[first], (np.add.reduceat(counts, first) if fps.size else counts)
    quotients = (fps >> shift).astype(np.int64) if bits else np.zeros(fps.size, np.int64)
    remainders = fps & ((np.uint64(1) << shift) - np.uint64(1)) if bits else fps
    starts = np.flatnonzero(np.concatenate(([True], quotients[1:] != quotients[:-1]))) if fps.size else np.array([], int)
    ends = np.append(starts[1:], fps.size)
    return pa.RecordBatch.from_arrays(
        [pa.array(quotients[starts], pa.int64()),
         pa.array([remainders[a:z].tobytes() for a, z in zip(starts, ends)], pa.binary()),
         pa.array([counts[a:z].tobytes() for a, z in zip(starts, ends)], pa.binary())],
        names=["quotient", "remainders", "counts"])


def partition_filters(fps: DataFrame, bits: int) -> DataFrame:
    """A counting quotient filter for each partition of the one-column frame ``fps``."""
    def build(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= PARTITION_ENTRIES:
                yield _runs(np.concatenate(held), np.ones(n, np.int64), bits)
                held, n = [], 0
        if n:
            yield _runs(np.concatenate(held), np.ones(n, np.int64), bits)

    return fps.mapInArrow(build, "quotient long, remainders binary, counts binary")


def merged_counts(filters: DataFrame, bits: int) -> DataFrame:
    """(fp, n) with n > 1 after merging the runs of each quotient by sorted remainders."""
    shift = 64 - bits

    def merge(key, table):
        remainders = np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("remainders").to_pylist()])
        counts = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist()])
        order = np.argsort(remainders, kind="stable")       # a merge of sorted runs
        remainders, counts = remainders[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], remainders[1:] != remainders[:-1])))
        total = np.add.reduceat(counts, first)
        more = total > 1
        quotient = np.uint64(key[0].as_py()) << np.uint64(shift) if bits else np.uint64(0)
        return pa.table({"fp": pa.array((remainders[first][more] | quotient).view(np.int64)),
                         "n": pa.array(total[more], pa.int64())})

    return filters.groupBy("quotient").applyInArrow(merge, "fp long, n long")


def _routing_bitmap(repeated: DataFrame, bits: int) -> bytes:
    """A bitmap of 2**bits positions (its size is fixed by the parameter) of the repeated fingerprints."""
    segments, width = 64, (1 << bits) // 64
    mask = (1 << bits) - 1
    spots = repeated.select(F.col("fp").bitwiseAND(F.lit(mask)).alias("p")).distinct() \
        .select(F.expr(f"p div {width}").alias("segment"), F.expr(f"cast(p % {width} as int)").alias("spot"))

    def pack(key, table):
        flags = np.zeros(width, np.uint8)
        flags[table.column("spot").to_numpy()] = 1
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()),
                         "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    rows = spots.groupBy("segment").applyInArrow(pack, "segment long, bits binary").collect()
    by = {r["segment"]: bytes(r["bits"]) for r in rows}
    return b"".join(by.get(s, bytes(width // 8)) for s in range(segments))


def _verified_groups(docs: DataFrame, id_col: str, text_col: str, bitmap: bytes, bits: int) -> DataFrame:
    """Groups of byte-equal normalised texts among the rows that the bitmap lets through."""
    held, mask = docs.sparkSession.sparkContext.broadcast(bitmap), (1 << bits) - 1
    kind = docs.schema[id_col].dataType

    def route(batches):
        flags = np.unpackbits(np.frombuffer(held.value, np.uint8))
        for batch in batches:
            keep, points, norms = [], [], []
            for i, raw in enumerate(utf8(batch.column(1))):
                norm = _normalised(raw)
                if flags[xxhash.xxh3_64_intdigest(norm) & mask]:
                    keep.append(i)
                    points.append(len(raw.decode("utf-8", "replace")))
                    norms.append(norm)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(points, pa.int64()),
                 pa.array(norms, pa.binary())], names=["id", "points", "norm"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("points", T.LongType()),
                           T.StructField("norm", T.BinaryType())])
    routed = docs.select(id_col, text_col).mapInArrow(route, schema)
    # the key is the whole normalised text, so rows meet only if every byte is equal
    same = routed.groupBy("norm", "points").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    return same.select(F.sha2("norm", 256).alias("sha"), "points", "n", "id") \
        .groupBy("sha").agg(F.sum("n").alias("group_size"), F.max("points").alias("best_points"),
                            F.max_by("id", "points").alias("best_id"))   # one row per text and length


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     routing_bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """(digests, groups) of ``docs``.

    ``digests`` has one row (id, points, fp, sha) per input row; ``groups`` one
    row (sha, group_size, best_points, best_id) per text that occurs twice or
    more.  Of equal texts the row with the most code points in the original
    stays, then the smallest id; null ids come last.
    """
    ship(docs.sparkSession)
    digests = materialise(
        docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("d")).select("id", "d.*"), "digests")
    rows = digests.count()
    bits = max(0, (max(rows, 1) // RUN_ENTRIES).bit_length())
    repeated = merged_counts(partition_filters(digests.select("fp"), bits), bits)
    bitmap = _routing_bitmap(repeated, routing_bits)
    groups = _verified_groups(docs, id_col, text_col, bitmap, routing_bits).where("group_size > 1")
    return digests, groups


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    routing_bits: int = 24) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts are equal to each other and to texts
    of white space only.  Rows repeated with their id keep that id each: all of
    them are marked kept (``drop_duplicates`` leaves one).  An empty table gives
    an empty result; other columns of ``docs`` play no part.
    """
    digests, groups = duplicate_groups(docs, id_col, text_col, routing_bits)
    return digests.join(groups, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull()
         | (F.col("id").eqNullSafe(F.col("best_id")) & (F.col("points") == F.col("best_points")))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    routing_bits: int = 24) -> DataFrame:
    """``docs`` with one row of each group of equal texts, in its own columns.

    The row of the smallest id among the longest originals stays.  Rows that
    share id, text and length (repeated rows) are ordered by their original text,
    then by all their columns; the first stays.
    """
    digests, groups = duplicate_groups(docs, id_col, text_col, routing_bits)
    alone = F.col("group_size").isNull()
    best = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("points") == F.col("best_points"))
    chosen = digests.join(groups, "sha", "left").where(alone | best) \
        .groupBy(F.concat_ws(":", "sha", "points").alias("key"), "id").agg(F.count(F.lit(1)).alias("copies"))
    of_row = digest(F.col(text_col))
    return keep_chosen(docs, F.concat_ws(":", of_row["sha"], of_row["points"]), chosen, id_col, text_col)
