"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes.  Two fingerprints that differ in d
bits agree in at least 8 - d of them.  The index lists fingerprints under pairs
of byte blocks (d + 2 blocks, of which at least two must agree).  Pairs on one
list are tallied: those that share 8 - d positional bytes are retained and then
verified on their bits.

A list can be long when many near copies exist.  Pairs are only formed on lists
up to ``list_limit``.  On a longer list every fingerprint is written under each
value within half the distance, so that linked fingerprints meet under a value
in between; the few that can meet there (the size of that ball) are linked as a
star.  Both ways find the same components, so the limit changes no result.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_chosen, materialise, ship, utf8
from .components import components

CHUNK = 1 << 16                  # shingle hashes whose bits are counted at a time


def fingerprint_of(text: bytes, shingle: int, seed: int) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = text.lower().split()                 # bytes.lower changes A-Z only
    if not words:
        return 0
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())
    hashes = np.array([digest(line[a:z], seed) for a, z in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, hashes.size, CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > hashes.size, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer; null counts as empty (fingerprint zero)."""
    def prints(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint_of(b, shingle, seed) for b in utf8(texts)), np.uint64, len(texts))
        return pa.array(out.view(np.int64))

    return F.arrow_udf(prints, T.LongType())(text)


def _blocks(max_bits: int) -> list[list[int]]:
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be from 0 to 6: eight bytes are cut into max_bits + 2 blocks")
    return [b.tolist() for b in np.array_split(np.arange(8), max_bits + 2)]


def _lists(max_bits: int) -> list[int]:
    """The masks of the index: every pair of blocks, as signed 64-bit integers."""
    masks = []
    for a, b in combinations(_blocks(max_bits), 2):
        mask = sum(0xFF << (8 * byte) for byte in a + b)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def shared_bytes(a: Column, b: Column) -> Column:
    """In how many of the eight positions two fingerprints have the same byte."""
    x = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for k in range(8))


def links(prints: DataFrame, max_bits: int = 2, list_limit: int = 64) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints within ``max_bits`` of each other.

    ``prints`` has one row per distinct fingerprint, in a column ``fp``.
    """
    spread = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(_lists(max_bits))])
    postings = prints.select("fp", F.explode(spread).alias("p")).select("p.list", "p.key", "fp")
    sizes = postings.groupBy("list", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    listed = materialise(postings.join(sizes, ["list", "key"]), "index")

    short = listed.where(F.col("size") <= list_limit).groupBy("list", "key").agg(F.collect_list("fp").alias("fps")) \
        .select(F.explode("fps").alias("u"), "fps")
    pairs = short.select("u", F.explode(F.filter("fps", lambda v: (v > F.col("u"))
                         & (shared_bytes(F.col("u"), v) >= 8 - max_bits))).alias("v")) \
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)

    # long lists: meet under every value within half the distance, over the bits that the list leaves free
    half = -(-max_bits // 2)
    free = [[bit for bit in range(64) if not (m >> bit) & 1] for m in _lists(max_bits)]
    flips = [[sum(1 << b for b in c) for r in range(half + 1) for c in combinations(bits, r)] for bits in free]
    signed = [[f - (1 << 64) if f >> 63 else f for f in one] for one in flips]
    table = prints.sparkSession.createDataFrame(
        [(i, one) for i, one in enumerate(signed)], "list int, flips array<long>")   # its size is set by max_bits
    long = listed.where(F.col("size") > list_limit).join(F.broadcast(table), "list") \
        .select("list", "fp", F.explode("flips").alias("flip")) \
        .select("list", F.col("fp").bitwiseXOR(F.col("flip")).alias("between"), "fp") \
        .groupBy("list", "between").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    if max_bits % 2 == 0:                        # all that meet are linked with each other
        stars = long.select(F.col("fps")[0].alias("u"), F.explode("fps").alias("v")).where("u <> v")
    else:
        stars = long.select(F.explode("fps").alias("u"), "fps") \
            .select("u", F.explode(F.filter("fps", lambda v: v > F.col("u"))).alias("v")) \
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return pairs.union(stars).distinct()


def _classes(prints: DataFrame, max_bits: int, list_limit: int) -> DataFrame:
    """(fp, root, component_id): the least id of all rows whose fingerprint is reachable from ``fp``."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = components(links(distinct.select("fp"), max_bits, list_limit)).withColumnRenamed("vertex", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    ship(docs.sparkSession)
    return materialise(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle, seed).alias("fp")),
                       "simhash")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42, list_limit: int = 64) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable).

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows and repeated ids get one row each; null ids are passed over
    when the smallest is taken (null if a component has no other).  An empty
    table gives an empty result; other columns of ``docs`` play no part.
    """
    prints = _prints(docs, id_col, text_col, shingle, seed)
    return prints.join(_classes(prints, max_bits, list_limit), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2, seed: int = 42, list_limit: int = 64) -> DataFrame:
    """``docs`` with one row of each component, in its own columns: the row of the smallest id.

    Among rows that share that id the least fingerprint stays, then the first
    by text and by all columns.
    """
    prints = _prints(docs, id_col, text_col, shingle, seed)
    classes = _classes(prints, max_bits, list_limit)
    chosen = prints.join(classes, "fp").where(F.col("id").eqNullSafe(F.col("component_id"))) \
        .groupBy("fp", "id").agg(F.count(F.lit(1)).alias("copies"))
    # an id that several rows share may stand for several fingerprints of one component
    first = chosen.join(classes, "fp").groupBy("root").agg(F.min(F.struct("fp", "id", "copies")).alias("c"))
    return keep_chosen(docs, fingerprint(F.col(text_col), shingle, seed),
                       first.select(F.col("c.fp").alias("key"), "c.id", "c.copies"), id_col, text_col)
