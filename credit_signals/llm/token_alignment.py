"""Alignment of two tokenizations of the same text, and how often ids are linked.

A text is encoded by a byte-level tokenizer (A, over a space and the text) and
by a SentencePiece model (B, which puts the space itself).  Neither joins what
is before a space (or a line end) that follows no white space to what is after:
there both have a token's end, and there a text is cut into short windows.  The
ids and the alignment of a window depend on its text alone, so they are kept by
that text; the windows of a batch that were not seen are encoded by both sides,
compared with their bytes and aligned together.

Inside a window the ends of both sides cut its bytes into pieces; each piece is
one link (an A and a B token whose bytes overlap), and each end that both sides
share closes a group.

Documents are encoded once: a table holds each document's digests and its
distinct linked id pairs.  Pair counts over the corpus are one aggregation of
that table; the counts come back to the documents by a broadcast join up to
``BROADCAST_PAIRS`` pairs, beyond it the most frequent pairs are broadcast and
the others, none of them hot, are joined by shuffling.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_automaton import WHITE, byte_codec, load_spec
from .common import batches, materialise

SPACE = "▁"
KEPT_WINDOWS = 150_000
LONGEST_KEPT = 64                # characters of a window that is kept
BROADCAST_PAIRS = 1_000_000
BATCH_CHARS = 1_000_000
NO_TOKENS = (0, 0, 0, 0, "", (), ())


# groups as text, number of groups, A ids, B ids, code of each link, whether both sides give the window's bytes
Window = tuple[str, int, int, int, bytes, bool]
WRONG: Window = ("", 0, 0, 0, b"", False)


class Windows:
    """Alignments of windows by their text; ``a_bytes`` and ``b_bytes`` are the bytes of each id."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.a_size = np.array([len(x) for x in a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in b_bytes], np.int64)
        self.b_ids = len(b_bytes)
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_text = [np.array([f"{i}{end}" for i in range(len(a_bytes))], object) for end in ",|"]
        self.b_text = [np.array([f"{i}{end}" for i in range(len(b_bytes))], object) for end in ",;\n"]
        self.known: dict[str, Window] = {}

    def verified(self, names: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether both sides give the bytes of each window."""
        want, out = [t.encode() for t in names], np.ones(len(names), bool)
        size = np.fromiter(map(len, want), np.int64, len(want))
        for ids, n, known, sizes in ((a, n_a, self.a_bytes, self.a_size), (b, n_b, self.b_bytes, self.b_size)):
            ends = np.append(0, np.cumsum(n))
            parts = [known[i] for i in ids.tolist()]
            if (np.diff(np.append(0, np.cumsum(sizes[ids]))[ends]) != size).any() or b"".join(parts) != b"".join(want):
                cuts = ends.tolist()
                out &= [b"".join(parts[p:q]) == w for w, p, q in zip(want, cuts, cuts[1:])]
        return out

    def align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> list[Window]:
        """The alignment of windows with the same bytes on both sides; ``n_a``, ``n_b`` are their numbers of ids."""
        number = np.arange(n_a.size)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.zeros(int(a_end[-1]) + 1, np.uint8)
        ends[a_end] = 1
        ends[b_end] += 2
        at = np.flatnonzero(ends)                        # each piece is one link
        left, right = np.searchsorted(a_end, at), np.searchsorted(b_end, at)
        codes = a[left] * self.b_ids + b[right]
        window_of_a = np.repeat(number, n_a)
        links = np.bincount(window_of_a[left], minlength=n_a.size)
        shared = ends[at] == 3
        groups = np.bincount(window_of_a[left[shared]], minlength=n_a.size)
        before = np.cumsum(ends == 3) - (ends == 3)      # groups closed before an offset
        a_text = np.where(ends[a_end] == 3, self.a_text[1][a], self.a_text[0][a])
        b_text = np.where(ends[b_end] == 3, self.b_text[1][b], self.b_text[0][b])
        closing = np.cumsum(n_b) - 1
        b_text[closing] = self.b_text[2][b[closing]]
        order = np.argsort(np.concatenate((2 * before[a_end], 2 * before[b_end] + 1)), kind="stable")
        texts = "".join(np.concatenate((a_text, b_text))[order].tolist()).split("\n")
        data, cuts = codes.tobytes(), (8 * np.cumsum(links)).tolist()
        return [(t, g, x, y, data[p:q], True) for t, g, x, y, p, q in
                zip(texts, groups.tolist(), n_a.tolist(), n_b.tolist(), [0, *cuts], cuts)]

    def aligned(self, names: list[str], encode) -> dict[str, Window]:
        """The alignment of each distinct window, kept ones included; ``encode`` gives both sides of new ones."""
        out = dict.fromkeys(names)
        new = []
        for name in out:
            known = out[name] = self.known.get(name)
            if known is None:
                new.append(name)
        if new:
            new, a, n_a, b, n_b = encode(new)
            fits = self.verified(new, a, n_a, b, n_b)
            if not fits.all():
                a, n_a, b, n_b = a[np.repeat(fits, n_a)], n_a[fits], b[np.repeat(fits, n_b)], n_b[fits]
            found = iter(self.align(a, n_a, b, n_b) if fits.any() else ())
            fresh = {name: next(found) if ok else WRONG for name, ok in zip(new, fits.tolist())}
            out.update(fresh)
            if len(self.known) + len(fresh) > KEPT_WINDOWS:      # begin anew with this batch's windows
                self.known, fresh = {}, out
            kept = ((name, value) for name, value in fresh.items() if len(name) <= LONGEST_KEPT)
            self.known.update(islice(kept, KEPT_WINDOWS - len(self.known)))
        return out


class Aligner:
    """Both tokenizers and the windows that were seen."""

    def __init__(self, spec: tuple, model: bytes):
        self.bytes_codec = byte_codec(spec, special=False, packed=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        labels = self.bytes_codec.labels
        self.piece_bytes, plain = [], []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.piece_bytes.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i)
                                    else piece.replace(SPACE, " ").encode())
            if not (self.pieces.is_byte(i) or self.pieces.is_control(i) or self.pieces.is_unknown(i)):
                plain.append(piece)
        self.windows = Windows([labels.get(i, b"") for i in range(max(labels) + 1)], self.piece_bytes)
        # a model with pieces across spaces, or one that rewrites white space, gets whole texts
        kept = {"": "", "a  b ": f"{SPACE}a{2 * SPACE}b{SPACE}", "\t\n \n": f"{SPACE}\t\n{SPACE}\n"}
        cuts = all(self.pieces.normalize(t) == want for t, want in kept.items()) and \
            not any(SPACE in p.lstrip(SPACE) for p in plain)
        ends = " " if any("\n" in p for p in plain) else r" \n"
        # white space, then all up to a space or line end that follows no white space
        self.ascii, self.window = (re.compile(
            rf"[{w}]*+[^{w}]++(?:(?![{ends}])[{w}]++[^{w}]++)*+(?:(?![{ends}])[{w}]++\Z)?|[{w}]++" if cuts else r"(?s).+")
            for w in (r"\t-\r ", WHITE))
        self.front = len(self.pieces.encode("\n"))

    def _sides(self, names: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows in another order, all their A ids and how many each has, the same of B."""
        codec = self.bytes_codec
        # A cuts before a window unless white space is in front, so the others are split into words together
        inner, outer = [n for n in names if not n[-1].isspace()], [n for n in names if n[-1].isspace()]
        names = inner + outer
        words = codec.units("".join(inner))
        words += chain.from_iterable(map(codec.units, outer))
        ids = codec.encode_units(set(words))
        data = [ids[w] for w in words]
        sizes = np.append(0, np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) // 4))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        stops = np.cumsum(np.fromiter(map(len, names), np.int64, len(names)))
        n_a = np.diff(sizes[np.searchsorted(ends, stops) + 1], prepend=0)
        # B puts a space in front of all but nothing; a line end that is put there joins nothing and goes again
        spaced = [name.startswith(" ") and name != " " for name in names]
        b = self.pieces.encode([name[1:] if s else f"\n{name}" for name, s in zip(names, spaced)], num_threads=1)
        b = [x if s else x[self.front:] for s, x in zip(spaced, b)]
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        return names, np.frombuffer(b"".join(data), np.int32).astype(np.int64), n_a, \
            np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum())), n_b

    def rows(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pair codes, links of each pair) of each text."""
        names = [(self.ascii if text.isascii() else self.window).findall(f" {text}") if text else [] for text in texts]
        flat = list(chain.from_iterable(names))
        if not flat:
            yield from (NO_TOKENS for _ in texts)
            return
        known = self.windows.aligned(flat, self._sides)
        number = dict(zip(known, range(len(known))))
        text, *columns, codes, verified = zip(*known.values())
        each = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        links = np.fromiter(map(len, codes), np.int64, len(codes)) // 8
        per_window = links[each]
        edge = np.cumsum(per_window)
        code = np.frombuffer(b"".join(codes), np.int64)[
            np.arange(int(edge[-1])) + np.repeat((np.cumsum(links) - links)[each] - edge + per_window, per_window)]
        cuts = np.cumsum([0, *map(len, names)])
        sums = [np.concatenate(([0], np.cumsum(np.array(c)[each])))[cuts] for c in (*columns, links, ~np.array(verified))]
        groups, n_a, n_b, n_links, wrong = (np.diff(s).tolist() for s in sums)
        each, last = each.tolist(), sums[3].tolist()
        for i, (begin, end) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if begin == end or wrong[i]:
                yield NO_TOKENS
                continue
            joined = ";".join([text[w] for w in each[begin:end]])
            pairs, times = np.unique(code[last[i]:last[i + 1]], return_counts=True)
            yield n_a[i], n_b[i], groups[i], n_links[i], hashlib.sha256(joined.encode()).hexdigest(), pairs, times


@lru_cache(maxsize=1)
def aligner(spec: tuple, model: bytes) -> Aligner:
    """One per worker."""
    return Aligner(spec, model)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_SCHEMA = pa.schema([("id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string()),
                     ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if ends[-1] else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def encode_pairs(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the counts, groups_sha256, its distinct linked pairs and how often each is linked.

    A pair is a_id * (number of B ids) + b_id.
    """
    spec = load_spec(docs, byte_path)
    with open(piece_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(spec.value, model.value)
        for part in parts:
            at = 0
            for texts in batches(part.column(1), BATCH_CHARS):
                columns = list(zip(*one.rows(texts)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(at, len(texts)), *[pa.array(c, pa.int64()) for c in columns[:4]],
                     pa.array(columns[4], pa.string()), _lists(columns[5], pa.int64()), _lists(columns[6], pa.int32())],
                    schema=_SCHEMA)
                at += len(texts)

    fields = ", ".join(f"{c} long" for c in _COUNTS)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(encode, f"id long, {fields}, groups_sha256 string, pairs array<long>, times array<int>")


def _exploded(encoded: DataFrame, *columns: str) -> DataFrame:
    return encoded.select(*columns, F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("k")))
                          .alias("pair", "k"))


def pair_counts(encoded: DataFrame, b_ids: int) -> DataFrame:
    """(pair, n, best): the links of every pair over the corpus, and whether no pair of its B id has more."""
    counts = materialise(_exploded(encoded).groupBy("pair").agg(F.sum("k").alias("n")), "alignment-pairs")
    most = counts.groupBy(F.pmod("pair", F.lit(b_ids)).alias("b")).agg(F.max("n").alias("most"))     # one row per B id
    return counts.withColumn("b", F.pmod("pair", F.lit(b_ids))).join(F.broadcast(most), "b") \
        .select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_counts(links: DataFrame, counts: DataFrame, n_pairs: int, most: int) -> DataFrame:
    """``links`` (row, pair, k) with n and best of each pair."""
    if n_pairs <= most:
        return links.join(F.broadcast(counts), "pair")
    # all pairs with more than (all links / most) links are at most ``most`` pairs; no other one is hot
    limit = -(-counts.agg(F.sum("n")).first()[0] // most)
    hot = counts.where(F.col("n") > limit)
    near = links.join(F.broadcast(hot), "pair")
    far = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(counts.where(F.col("n") <= limit), "pair")
    return near.unionByName(far)


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that the two sides do not give back byte for
    byte, have no tokens: zeros and an empty digest.  A very long text is one
    batch of its own.  Repeated rows get a row each and add to the counts each
    time; null ids stay null; an empty table gives an empty result; other
    columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    b_ids = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    encoded = materialise(encode_pairs(docs, byte_path, piece_path, id_col, text_col)
                          .withColumn("row", F.monotonically_increasing_id()), "alignment-documents")
    counts = materialise(pair_counts(encoded, b_ids), "alignment-counts")
    links = _exploded(encoded, "row")
    sums = _with_counts(links, counts, counts.count(), broadcast_pairs).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    return encoded.select("row", F.col("id").alias(id_col), *_COUNTS, "groups_sha256").join(sums, "row", "left") \
        .select(id_col, *_COUNTS, F.coalesce("n_best", F.lit(0)).alias("n_best"),
                F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
