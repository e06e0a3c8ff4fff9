"""Spelling variants: words one edit apart, and the form that each belongs to.

Words are counted in the corpus (``count_words``); ``near_words`` then finds for
every word the vocabulary words that differ by one inserted, deleted or replaced
code point, with a bit-sliced position index: a bitset per (position, letter)
over a block of the vocabulary.  A query word is read once; three recurrences
run side by side, word-parallel, over the block: the words equal so far, the
words with one letter replaced, and the words with one letter more, which match
at positions shifted by one.

No task sees the whole vocabulary.  Of two words one edit apart the shorter has
c letters, and they agree in their first or their last c // 2 letters.  Words
meet in blocks of (c, side, those letters); blocks at the end of words are read
backwards, so the agreeing letters always come first.  A block with more than
``BLOCK`` words is cut into chunks and its queries are repeated for each, and
small blocks share a group.  What leaves a group is one row per word, not pairs.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, ship

WORD = re.compile("[a-zÀ-ÿ]+")     # after A-Z are lower-cased
BLOCK = 4096                     # words of a block that one task indexes
GROUP = 1024                     # vocabulary words per group of one length and side
HELD_WORDS = 300_000             # distinct words a task counts before it hands them on
QUERIES = 256                    # query words that advance together
BROADCAST_BLOCKS = 500_000


# --- counting ----------------------------------------------------------------------

def _typed(doc_id: bytes, runs: Counter, noise: int, shortest: int) -> Iterator[tuple[str, int]]:
    """The words that a document's runs become, with their counts.

    With ``noise`` a run whose CRC-32 of "<doc_id>:<run>" it divides loses one letter.
    """
    if not noise:
        yield from runs.items()
        return
    start = zlib.crc32(doc_id + b":")
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < shortest:
                continue
        yield run, n


def count_words(docs: DataFrame, shortest: int = 6, fewest: int = 5, noise: int = 0, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n) of the words with at least ``shortest`` code points and ``fewest`` occurrences.

    Words are maximal runs of Latin letters, A-Z lower-cased.  Null texts have
    none; a null id counts as empty text in the noise rule.
    """
    ship(docs.sparkSession)
    long_runs = re.compile(f"{WORD.pattern[:-1]}{{{max(1, shortest)},}}")   # a shorter run cannot become a word
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def hand_on():
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             schema=schema)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for i, text in zip(some.column(0).to_pylist(), some.column(1).cast(pa.binary()).to_pylist()):
                    if text:
                        runs = Counter(long_runs.findall(text.lower().decode()))     # bytes: only A-Z change
                        for word, n in _typed((i or "").encode(), runs, noise, shortest):
                            held[word] += n
                        if len(held) > HELD_WORDS:
                            yield from hand_on()
        yield from hand_on()

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# --- words one edit apart -----------------------------------------------------------

def _codes(words: list[str], width: int, letters: dict[str, int]) -> np.ndarray:
    """Letter numbers, one row per word, padded with 0."""
    out = np.zeros((len(words), width), np.int32)
    for i, w in enumerate(words):
        out[i, :len(w)] = [letters[c] for c in w]
    return out


class PositionIndex:
    """Bitsets per (position, letter) over words of ``c`` and ``c + 1`` letters that start alike."""

    def __init__(self, words: list[str], c: int):
        self.c, self.n = c, len(words)
        self.letters = {x: i + 1 for i, x in enumerate(sorted(set().union(*words)))}
        codes = _codes(words, c + 1, self.letters)
        width = -(-self.n // 64)
        self.bits = np.zeros((c + 2, len(self.letters) + 1, width), np.uint64)
        for p in range(c + 1):
            here = np.zeros((len(self.letters) + 1, width * 64), bool)
            here[codes[:, p], np.arange(self.n)] = codes[:, p] > 0
            self.bits[p] = np.packbits(here, axis=1, bitorder="little").view(np.uint64)
        longer = np.zeros(width * 64, bool)
        longer[:self.n] = [len(w) > c for w in words]
        self.longer = np.packbits(longer, bitorder="little").view(np.uint64)
        valid = np.zeros(width * 64, bool)
        valid[:self.n] = True
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)

    def near(self, queries: list[str], same: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number) of all pairs one edit apart whose first ``same`` letters agree.

        Queries have ``c`` letters.  ``equal``, ``replaced`` and ``longer`` are, for all
        words of the index at once, whether the letters read so far agree, agree
        but for one, or agree with the word read one position ahead.
        """
        who, found = [], []
        for at in range(0, len(queries), QUERIES):
            some = queries[at:at + QUERIES]
            codes = np.zeros((len(some), self.c), np.int32)
            for i, q in enumerate(some):                          # a letter that no word has is 0: an empty bitset
                codes[i] = [self.letters.get(x, 0) for x in q]
            equal = np.broadcast_to(self.valid, (len(some), self.valid.size)).copy()
            replaced, longer = np.zeros_like(equal), np.zeros_like(equal)
            for p in range(self.c):
                here = self.bits[p][codes[:, p]]
                if p >= same:
                    ahead = self.bits[p + 1][codes[:, p]]
                    longer |= equal
                    longer &= ahead
                    replaced &= here
                    replaced |= equal & ~here
                equal &= here
            hits = (replaced & ~self.longer) | ((longer | equal) & self.longer)
            rows, cells = np.nonzero(hits)
            inside = np.unpackbits(hits[rows, cells].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, bit = np.nonzero(inside)
            who.append(rows[i] + at)
            found.append(cells[i] * 64 + bit)
        return np.concatenate(who), np.concatenate(found)


_BEST = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _group(table: pa.Table) -> pa.Table:
    """One row per word of the group that has a near word in it: how many, and the most frequent."""
    c, side = table.column("c")[0].as_py(), table.column("side")[0].as_py()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    is_query = np.array(table.column("query").to_pylist(), bool)
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))     # the best near word is the first of them
    index = [i for i in order if not is_query[i]]
    asked = list({words[i]: i for i in order if is_query[i]}.values())     # chunks of one block may share the group
    if not index or not asked:
        return _BEST.empty_table()
    same = c // 2
    turn = slice(None, None, -1) if side else slice(None)
    q, w = PositionIndex([words[i][turn] for i in index], c).near([words[i][turn] for i in asked], same)
    if side:                                       # pairs that also start alike are found at their start
        starts: dict[str, int] = {}
        start_q = np.array([starts.setdefault(words[i][:same], len(starts)) for i in asked])
        start_w = np.array([starts.setdefault(words[i][:same], len(starts)) for i in index])
        new = start_q[q] != start_w[w]
        q, w = q[new], w[new]
    up = np.array([len(words[i]) for i in index])[w] > c       # a longer word is not a query here: told both ways
    out = []
    for one, other, rows, near in ((q, w, asked, index), (w[up], q[up], index, asked)):
        count = np.bincount(one, minlength=len(rows))
        first = np.full(len(rows), len(near))
        np.minimum.at(first, one, other)
        has = np.flatnonzero(count)
        best = [near[i] for i in first[has]]
        out.append(pa.table([[words[rows[i]] for i in has], count[has], n[best], [words[i] for i in best]], schema=_BEST))
    return pa.concat_tables(out)


def _block_rows(vocabulary: DataFrame) -> DataFrame:
    """(c, side, half, word, n, query): each word as an index word of four blocks and as a query of two."""
    size = F.length("word")

    def row(c: Column, side: int, query: bool) -> Column:
        half = F.floor(c / 2).cast("int")
        letters = F.substring("word", F.lit(1), half) if side == 0 else F.reverse(F.substring("word", size - half + 1, half))
        return F.struct(c.cast("int").alias("c"), F.lit(side).alias("side"), letters.alias("half"), F.lit(query).alias("query"))

    roles = [row(size, side, query) for side in (0, 1) for query in (False, True)]
    roles += [row(size - 1, side, False) for side in (0, 1)]
    return vocabulary.select("word", "n", F.inline(F.array(*roles)))


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words in ``vocabulary`` (word, n).

    ``best`` is the near word of largest n, of equal ones the first in code-point
    order.  Words must be distinct; the vocabulary is read several times, so it
    should be a written table.
    """
    spark = vocabulary.sparkSession
    ship(spark)
    rows = _block_rows(vocabulary.where(F.length("word") > 0))
    key = ["c", "side", "half"]
    large = materialise(rows.where(~F.col("query")).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
                        .where(F.col("rows") > block).select(*key, F.ceil(F.col("rows") / block).cast("int").alias("chunks")),
                        "spelling-blocks")
    n_large = large.count()                        # at most four rows a word over ``block``
    if n_large:
        rows = rows.join(F.broadcast(large) if n_large <= BROADCAST_BLOCKS else large, key, "left") \
            .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        rows = rows.withColumn("chunk", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("chunks") - 1))
                                                  .otherwise(own)))
    else:
        rows = rows.withColumn("chunk", F.lit(0))
    groups = 1 + vocabulary.count() // GROUP
    grouped = rows.withColumn("g", F.pmod(F.xxhash64("half", "chunk"), F.lit(groups)).cast("int")) \
        .select("c", "side", "g", "word", "n", "query")
    found = grouped.groupBy("c", "side", "g").applyInArrow(
        _group, T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                              T.StructField("best_n", T.LongType()), T.StructField("best", T.StringType())]))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best"))).alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


# --- forms and roots ------------------------------------------------------------------

def variants(vocabulary: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``vocabulary`` (word, n).

    A word's form is its best near word if that is at least ``ratio`` (above 1)
    times as frequent.  Counts grow along forms, so they end at a root; chains
    are followed by doubling, log2 of their length rounds.  A word without near
    words has n_near 0, no form, and is its own root; an empty vocabulary gives
    an empty result.  Other columns play no part; words must be distinct.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: counts have to grow along forms")
    vocabulary = vocabulary.select("word", "n")
    found = materialise(vocabulary.join(near_words(vocabulary, block), "word", "left")
                        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
                                F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n")),
                        "spelling-forms")
    steps = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = materialise(steps.join(ahead, "root", "left")
                            .select("word", F.coalesce("further", "root").alias("root"),
                                    F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.select("word", "root")
    return found.join(steps.select("word", "root"), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, shortest: int = 6, fewest: int = 5, ratio: int = 5, noise: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of ``docs``: word, form, root, n, n_near, form_n.

    Null and empty texts have no words, an empty table gives an empty result, and
    repeated rows count each time.  A very long text is read whole by one task,
    which holds its distinct words.  Other columns of ``docs`` play no part.
    """
    vocabulary = materialise(count_words(docs, shortest, fewest, noise, id_col, text_col), "spelling-words")
    return variants(vocabulary, ratio)
