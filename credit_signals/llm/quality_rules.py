"""Quality rules on repetition.

The words of a text become exact numbers; rolling hashes over these numbers
give the n-grams of several lengths at once.  The rules measure what share of a
text's characters lies inside n-grams that occur twice or more, and inside
lines that occurred before.  Whole texts are read; a text is judged alone, so
rows need no shuffle.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ship, utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 8                       # words of a repeated window (base rule)
LENGTHS = (5, 8, 10)             # n-gram lengths of the coverage rules


@dataclass(frozen=True)
class RepetitionLimits:
    """The largest share of word characters inside repeats that a kept text may have."""

    min_words: int = 20
    max_repeat_words_pct: int = 30
    max_ngram_share: tuple[float, ...] = (0.35, 0.32, 0.32)     # for LENGTHS
    max_line_share: float = 0.30
    max_symbols_per_word: float = 0.3


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(ids: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """{n: hashes of all n-word windows}; each is joined from two shorter rolling hashes."""
    known = {1: _scramble(ids.astype(np.uint64))}

    def window(n: int) -> np.ndarray:
        if n not in known:
            a = 1 << ((n - 1).bit_length() - 1)
            left, right = window(a), window(n - a)
            m = max(0, ids.size - n + 1)
            known[n] = (left[:m] ^ (left[:m] >> np.uint64(32))) * (_BASE + np.uint64(2 * n)) + right[a:a + m]
        return known[n]

    return {n: window(n) for n in lengths}


def covered(ids: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word window that occurs twice or more (the first included)."""
    out = np.zeros(ids.size, bool)
    if hashes.size < 2:
        return out
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return out
    a, b = order[:-1][same], order[1:][same]
    equal = np.ones(a.size, bool)
    for k in range(n):
        equal &= ids[a + k] == ids[b + k]
    if equal.all():
        starts = np.concatenate((a, b))
    else:                                        # two windows with one hash: compare the windows themselves
        seen: dict[tuple, int] = {}
        hit = set()
        for i in range(hashes.size):
            j = seen.setdefault(tuple(ids[i:i + n]), i)
            if j != i:
                hit.update((i, j))
        starts = np.fromiter(hit, np.int64, len(hit))
    step = np.zeros(ids.size + 1, np.int64)
    marks = np.unique(starts)
    step[marks] += 1
    np.subtract.at(step, marks + n, 1)
    return np.cumsum(step[:-1]) > 0


def measure(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line share, share per n-gram length)."""
    words = text.split()                         # splits at exactly the six ASCII white-space characters
    n = len(words)
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    if not n:
        return (0, 0, n_symbols, 0, 0, 0.0, *(0.0 for _ in LENGTHS))
    seen: set[bytes] = set()
    dup_lines, dup_points = 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                dup_lines += 1
                dup_points += len(b"".join(line.split()).decode("utf-8", "replace"))
            else:
                seen.add(line)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    raw = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[raw]
    points = np.concatenate(([0], np.cumsum(inside & ((raw & 0xC0) != 0x80))))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    lengths = points[np.flatnonzero(edge == -1)] - points[np.flatnonzero(edge == 1)]
    total = int(points[-1])
    cover, none = {}, np.zeros(n, bool)
    longer = sorted({*LENGTHS, WINDOW})
    hashes = rolling(ids, tuple(longer))
    for m in longer:                             # a repeated window repeats its shorter windows too
        cover[m] = covered(ids, hashes[m], m) if m == longer[0] or cover[longer[0]].any() else none
    shares = (float(lengths[cover[m]].sum()) / total for m in LENGTHS)
    return (n, total, n_symbols, dup_lines, int(cover[WINDOW].sum()), dup_points / total, *shares)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_share",
          *(f"dup_{n}gram_share" for n in LENGTHS))
_MEASURES = T.StructType([T.StructField(f, T.LongType() if i < 5 else T.DoubleType()) for i, f in enumerate(FIELDS)])


def _measure(texts: pa.Array) -> pa.Array:
    columns = list(zip(*map(measure, utf8(texts)))) or [()] * len(FIELDS)
    kinds = [pa.int64()] * 5 + [pa.float64()] * (1 + len(LENGTHS))
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(FIELDS))


def repetition(text: Column) -> Column:
    """struct of ``FIELDS`` for a text column."""
    return F.arrow_udf(_measure, _MEASURES)(text)


def base_failed(m: str, limits: RepetitionLimits) -> Column:
    """The base rule: too few words, or too many words inside repeated windows."""
    return ((F.col(f"{m}.n_words") < limits.min_words)
            | (100 * F.col(f"{m}.n_repeat_words") > limits.max_repeat_words_pct * F.col(f"{m}.n_words")))


def rules(m: str, limits: RepetitionLimits) -> dict[str, Column]:
    """{reason: fails}, the base rule first."""
    out = {"base": base_failed(m, limits)}
    for n, most in zip(LENGTHS, limits.max_ngram_share):
        out[f"dup_{n}grams"] = F.col(f"{m}.dup_{n}gram_share") > most
    out["dup_lines"] = F.col(f"{m}.dup_line_share") > limits.max_line_share
    out["symbols"] = F.col(f"{m}.n_symbols") > limits.max_symbols_per_word * F.col(f"{m}.n_words")
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """One row per input row: id, the measures, base_failed, kept and the first failed rule as ``reason``.

    Null and empty texts have no words and fail the base rule.  Repeated rows
    are judged alike; an empty table gives an empty result; other columns of
    ``docs`` play no part, and a null id stays null.
    """
    ship(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("id"), repetition(F.col(text_col)).alias("m"))
    fails = rules("m", limits)
    return found.select(
        F.col("id").alias(id_col), "m.*", fails["base"].alias("base_failed"),
        (~F.greatest(*fails.values())).alias("kept"),
        F.coalesce(*[F.when(c, F.lit(name)) for name, c in fails.items()]).alias("reason"))


def keep(docs: DataFrame, text_col: str = "text", limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """The rows of ``docs`` that pass every rule, in their own columns."""
    ship(docs.sparkSession)
    m = free_name(docs, "repetition_of_row")
    return docs.withColumn(m, repetition(F.col(text_col))) \
        .where(~F.greatest(*rules(m, limits).values())).select(*docs.columns)
