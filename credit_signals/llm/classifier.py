"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    logit = w0 + sum w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The bracket is all pairwise interactions in time linear in the features.  The
model is fitted in numpy on at most ``sample_rows`` labelled documents (those
with the least hash of their id), whose features alone reach the driver; its
size is fixed by ``BUCKETS`` and ``FACTORS``.  Scoring reads every whole text in
the tasks that hold it.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, utf8

BUCKETS, FACTORS = 1 << 15, 8
SYMBOLS, CAPITALS, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789"
POINTS, LETTERS = b".,;:!?", bytes(range(65, 91)) + bytes(range(97, 123))
STRUCTURE = ("log_words", "log_bytes", "mean_word", "capitals", "digits", "symbols", "points", "exclamations", "pipes",
             "not_ascii", "distinct_words", "commonest_word", "words_per_line", "dup_lines", "short_words", "hyphens")


def _share(text: bytes, of: bytes) -> float:
    return (len(text) - len(text.translate(None, of))) / max(1, len(text))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(word buckets, their values, structure statistics) of a whole text."""
    words = text.lower().split()
    counts = Counter(words)
    n = len(words)
    digest = xxhash.xxh32_intdigest
    buckets = np.fromiter((digest(w) & (BUCKETS - 1) for w in counts), np.int32, len(counts))
    values = 1.0 + np.log(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= max(1e-6, float(np.sqrt((values ** 2).sum())))
    lines = [x for x in text.split(b"\n") if x.strip()]
    structure = [
        np.log1p(n), np.log1p(len(text)), sum(map(len, words)) / max(1, n), _share(text, CAPITALS), _share(text, DIGITS),
        _share(text, SYMBOLS), _share(text, POINTS), _share(text, b"!"), _share(text, b"|"),
        _share(text, bytes(range(128, 256))), len(counts) / max(1, n), max(counts.values(), default=0) / max(1, n),
        np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        sum(len(w) < 3 for w in words) / max(1, n), _share(text, b"-_"),
    ]
    return buckets, values.astype(np.float32), [float(s) for s in structure]


@dataclass
class Machine:
    """Weights of the machine; dense features (structure, metadata) follow the word buckets."""

    bias: float
    linear: np.ndarray           # (features,)
    factors: np.ndarray          # (features, FACTORS)
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, buckets: list[np.ndarray], values: list[np.ndarray], dense: np.ndarray):
        """(feature numbers, values, row starts) of documents, flat; each row is its words and its dense features."""
        z = np.clip((dense - self.mean) / self.scale, -4, 4).astype(np.float32) / np.sqrt(dense.shape[1] or 1)
        names = np.arange(BUCKETS, BUCKETS + dense.shape[1], dtype=np.int32)
        index = np.concatenate([x for b in buckets for x in (b, names)])
        value = np.concatenate([x for v, d in zip(values, z) for x in (v, d)])
        sizes = np.fromiter((len(b) + len(names) for b in buckets), np.int64, len(buckets))
        return index, value, np.cumsum(sizes) - sizes

    def logits(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logits, sums of v x per row and factor); the second is what the gradient needs."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, starts, axis=0)
        squares = np.add.reduceat(weighted ** 2, starts, axis=0)
        line = np.add.reduceat(self.linear[index] * value, starts)
        return self.bias + line + 0.5 * (sums ** 2 - squares).sum(axis=1), sums

    def score(self, buckets, values, dense) -> np.ndarray:
        if not len(buckets):
            return np.array([])
        logits, _ = self.logits(*self.rows(buckets, values, dense))
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def fit(buckets: list[np.ndarray], values: list[np.ndarray], dense: np.ndarray, labels: np.ndarray, steps: int = 200,
        batch: int = 250, rate: float = 0.02, decay: float = 1e-4, seed: int = 42) -> Machine:
    """A machine fitted by about ``steps`` steps of Adam on log loss.

    Without labels of both kinds it answers their share (1/2 if there are none).
    """
    rng = np.random.default_rng(seed)
    wide = dense.shape[1]
    size = BUCKETS + wide
    mean = dense.mean(axis=0) if len(dense) else np.zeros(wide)
    scale = np.maximum(dense.std(axis=0), 1e-6) if len(dense) else np.ones(wide)
    share = (labels.sum() + 1) / (len(labels) + 2)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32),
                rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32), mean, scale)
    if len(np.unique(labels)) < 2:
        m.factors[:] = 0
        return m
    table = np.concatenate([m.linear[:, None], m.factors], axis=1)       # one row per feature: w_i, v_i
    first, second, step = np.zeros_like(table), np.zeros_like(table), 0
    while step < steps:
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            index, value, starts = m.rows([buckets[i] for i in part], [values[i] for i in part], dense[part])
            logits, sums = m.logits(index, value, starts)
            off = (1 / (1 + np.exp(-logits)) - labels[part]) / len(part)
            row = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(index))))
            pull = off[row] * value
            grad = np.empty_like(table)
            grad[:, 0] = np.bincount(index, pull, size)
            for f in range(FACTORS):             # d/dv_if = x_i (sum_j v_jf x_j - v_if x_i)
                grad[:, f + 1] = np.bincount(index, pull * (sums[row, f] - m.factors[index, f] * value), size)
            grad += decay * table
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad ** 2 - second)
            table -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            m.bias -= rate * float(off.sum())
            m.linear, m.factors = table[:, 0].copy(), table[:, 1:].copy()
    return m


_FEATURES = T.StructType([T.StructField("buckets", T.ArrayType(T.IntegerType())),
                          T.StructField("values", T.ArrayType(T.FloatType())),
                          T.StructField("structure", T.ArrayType(T.DoubleType()))])


def _features(texts: pa.Array) -> pa.Array:
    rows = [features(b) for b in utf8(texts)]
    b, v, s = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(b, pa.list_(pa.int32())), pa.array(v, pa.list_(pa.float32())),
                                       pa.array(s, pa.list_(pa.float64()))], names=_FEATURES.names)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(False))


def _dense(structure: list, metadata: list) -> np.ndarray:
    meta = np.array(metadata, float).reshape(len(structure), -1)
    known = ~np.isnan(meta)
    return np.concatenate([np.array(structure, float).reshape(len(structure), -1),
                           np.log1p(np.maximum(0, np.where(known, meta, 0))), known.astype(float)], axis=1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          metadata: tuple[str, ...] = ("n_chars",), sample_rows: int = 4000) -> Machine:
    """A machine fitted on at most ``sample_rows`` labelled rows outside the held-out fold.

    Rows with a null id or label are passed over; an id with several labels
    counts with the least.  Of documents that share a labelled id each counts.
    """
    ship(docs.sparkSession)
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label")) \
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    meta = F.array(*[F.col(c).cast("double") for c in metadata]) if metadata else F.array().cast("array<double>")
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), meta.alias("meta")) \
        .join(F.broadcast(chosen), "id") \
        .withColumn("f", F.arrow_udf(_features, _FEATURES)("text")) \
        .select("id", "label", "meta", "f.*").orderBy(F.xxhash64("id"), "id").limit(sample_rows)     # repeated ids included
    rows = found.collect()
    nan = float("nan")
    dense = _dense([r["structure"] for r in rows], [[nan if x is None else x for x in r["meta"]] for r in rows]) if rows \
        else np.zeros((0, len(STRUCTURE) + 2 * len(metadata)))
    return fit([np.array(r["buckets"], np.int32) for r in rows], [np.array(r["values"], np.float32) for r in rows],
               dense, np.array([float(r["label"]) for r in rows]))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
          metadata: tuple[str, ...] = ("n_chars",), threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted.

    Null and empty texts are scored by structure and metadata alone; null
    metadata counts as unknown.  Repeated rows get a row each; a null id is not
    held out; an empty table gives an empty result; no other column is read.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def scores(texts: pa.Array, *meta: pa.Array) -> pa.Array:
        out = []
        columns = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in meta]
        for at in range(0, len(texts), 256):     # bounded memory for long texts
            rows = [features(b) for b in utf8(texts.slice(at, 256))]
            side = [[c[at + i] for c in columns] for i in range(len(rows))]
            out.append(model.value.score([r[0] for r in rows], [r[1] for r in rows], _dense([r[2] for r in rows], side)))
        return pa.array(np.round(np.concatenate(out), 6) if out else [], pa.float64())

    scored = F.arrow_udf(scores, T.DoubleType())(F.col(text_col), *[F.col(c) for c in metadata])
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), scored.alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
