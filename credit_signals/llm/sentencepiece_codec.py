"""SentencePiece (BPE) encoding and decoding with a prefix table.

A merge-type encoding has two properties that the table rests on.  The encoding
of a prefix ends in one definite last token, and a token sequence is the
encoding of its text exactly if every neighbouring pair is: the first merge
across a token edge would also happen in the pair alone.  So for every prefix
the table stores its last token: the one match of an Aho-Corasick automaton
ending there whose own prefix ends in a compatible token.  The ids are then
recovered from the end backwards.

Texts are cut into units at spaces and line ends, which no piece of the model
spans (checked when the model is loaded; a model with such pieces is encoded
uncut).  Each distinct unit of a batch of texts is encoded once, all new ones
together (``last_tokens``), and decoded again; a worker keeps recent units and
the answers of pair tests in tables of fixed size.
"""

import hashlib
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, free_name, ship
from .last_tokens import LastTokens, Memo

SPACE = "▁"
CACHED_UNITS = 150_000
PAIR_BITS = 20                   # 2^20 answers of pair tests are kept
LONGEST_CACHED = 64
BATCH_CHARS = 500_000            # units and ids of a batch take some 50 bytes a character


class Codec:
    """Encodes and decodes one model; holds its automaton and caches."""

    def __init__(self, model: bytes):
        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = source.get_piece_size()
        self.pieces = [source.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if source.is_control(i) or source.is_unknown(i)}
        self.control = frozenset(i for i in special if source.is_control(i))
        self.unknown = source.unk_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if source.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.score = {p: source.get_score(i) for i, p in enumerate(self.pieces)
                      if i not in special and i not in self.byte_of}
        self.id = {p: i for i, p in enumerate(self.pieces) if p in self.score}
        self.plain = frozenset(self.id.values())
        self.single = frozenset(p for p in self.id if len(p) == 1)
        self.joined = frozenset(c for p in self.id if len(p) > 1 for c in p)
        inside = any(SPACE in p.lstrip(SPACE) for p in self.id)
        line = "" if "\n" in self.joined else r"\n"
        self.unit = re.compile(rf"[ {SPACE}]+[^ {SPACE}{line}]*|[^ {SPACE}{line}]+" + (r"|\n+" if line else "")) \
            if not inside else re.compile(r"(?s).+")
        self.alone = np.full(size, -1, np.int8)      # whether a piece encodes to itself, once asked
        self.pairs = Memo(self._compatible, PAIR_BITS)
        self.table = LastTokens([(p.encode(), i) for p, i in self.id.items()], self.pairs, self._stands_alone)
        names = [str(i) for i in range(size)]
        self.inside, self.at_end = np.array([f"{i}," for i in names], object), np.array([f"{i};" for i in names], object)
        self.known: dict[str, str] = {}
        self.changed: dict[str, str] = {}            # known units that decode to another text

    def merge(self, text: str) -> list[str]:
        """The definition: join the best neighbouring pair (score, then leftmost) until none is a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart: their joined text encodes to exactly this pair.

        ``left`` is -1 at the start of a unit: then whether ``right`` encodes to itself.
        """
        b = self.pieces[right]
        return self.merge(self.pieces[left] + b) == [self.pieces[left], b] if left >= 0 else self.merge(b) == [b]

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.compatible, left.tolist(), right.tolist()), bool, left.size)

    def _stands_alone(self, ids: np.ndarray) -> np.ndarray:
        for i in np.unique(ids[self.alone[ids] < 0]).tolist():
            self.alone[i] = self.compatible(-1, i)
        return self.alone[ids] == 1

    def _by_table(self, text: str) -> list[int]:
        """Ids of a text whose characters all are pieces."""
        return self.table.split([text.encode()])[0].tolist() if text else []

    def _of_unknown(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a text with spaces already written as U+2581."""
        strange = set(unit) - self.single
        if not strange:
            return self._by_table(unit)
        if strange & self.joined:                # part of longer pieces only: follow the definition
            return [i for p in self.merge(unit) for i in ([self.id[p]] if p in self.id else self._of_unknown(p))]
        ids, at = [], 0
        for i, c in enumerate(unit):             # joins nothing, so it cuts the unit
            if c in strange:
                ids += self._by_table(unit[at:i]) + self._of_unknown(c)
                at = i + 1
        return ids + self._by_table(unit[at:])

    def _surface(self, ids: list[int]) -> str:
        """Text of ids, the space at the start included."""
        if self.plain.issuperset(ids):
            return "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_lenient(bytes(run)))
                run.clear()
            if i >= 0 and i not in self.control:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(SPACE, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of an id sequence; the space that encoding put in front is taken away."""
        first = next((i for i in ids if i not in self.control), None)
        text = self._surface(ids)
        return text[1:] if first in self.plain and self.pieces[first].startswith(SPACE) else text

    def units(self, text: str) -> list[str]:
        """A whole text, with the space that encoding puts in front, cut where no piece reaches across."""
        return self.unit.findall(" " + text) if text else []

    def encode_units(self, distinct: set[str]) -> dict[str, str]:
        """The ids of each unit as text; units that were not kept are encoded, and decoded, together."""
        old = self.known
        out = {name: old[name] for name in distinct & old.keys()}
        new = list(distinct - out.keys())
        written = [name.replace(" ", SPACE) for name in new]
        plain = self.single.issuperset
        usual = [i for i, text in enumerate(written) if plain(text)]
        fresh = {}
        if usual:
            source = [written[i].encode() for i in usual]
            tokens, ends = self.table.split(source)
            texts = self.inside[tokens]
            texts[ends - 1] = self.at_end[tokens[ends - 1]]
            fresh = dict(zip([new[i] for i in usual], "".join(texts.tolist()).split(";")))
            if "".join(map(self.pieces.__getitem__, tokens.tolist())).encode() != b"".join(source):
                raise AssertionError("the pieces do not give the text again")
        for i in set(range(len(new))).difference(usual):
            fresh[new[i]] = ",".join(map(str, self.encode_unit(written[i])))
        if len(old) + len(fresh) > CACHED_UNITS:      # begin anew with this batch's units
            old = self.known = {}
            self.changed = {}
            again = out | fresh
        else:
            again = fresh
        out.update(fresh)
        for name, ids in again.items():
            if SPACE in name or not (name.isascii() and name.isprintable()):     # others are their pieces, as compared
                text = self._surface([int(i) for i in ids.split(",")])
                if text != name:
                    self.changed[name] = text
        kept = ((name, ids) for name, ids in again.items() if len(name) <= LONGEST_CACHED)
        old.update(islice(kept, CACHED_UNITS - len(old)))
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each text."""
        names = [self.units(text) for text in texts]
        distinct = set().union(*names)
        ids = self.encode_units(distinct)
        changed = distinct & self.changed.keys()
        get, other = ids.__getitem__, self.changed.get
        out = [(",".join(map(get, row)), text if not changed or changed.isdisjoint(row)
                else "".join([other(name, name) for name in row])[1:]) for text, row in zip(texts, names)]
        for name in changed:
            if len(name) > LONGEST_CACHED:
                del self.changed[name]
        return out

    def encode(self, text: str) -> list[int]:
        return numbers(self.encode_batch([text])[0][0])


def numbers(ids: str) -> list[int]:
    return [int(i) for i in ids.split(",")] if ids else []


def _digest(ids: str, decoded: str) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
    return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), \
        hashlib.sha256(decoded.encode()).hexdigest()


def _digests(one: Codec, texts: pa.Array) -> list[tuple[int, str, str]]:
    return [_digest(*row) for some in batches(texts, BATCH_CHARS) for row in one.encode_batch(some)]


def _lenient(run: bytes) -> str:
    """UTF-8 text; each byte that is not part of a character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec per model and worker."""
    return Codec(model)


def _model(df: DataFrame, path: str):
    ship(df.sparkSession)
    with open(path, "rb") as file:               # on the driver; Spark sends it on
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_column(df: DataFrame, path: str, text: Column) -> Column:
    """array<int> of the ids of a text column; null counts as empty (no ids)."""
    model = _model(df, path)

    def encode(texts: pa.Array) -> pa.Array:
        one = codec(model.value)
        return pa.array([numbers(ids) for some in batches(texts, BATCH_CHARS) for ids, _ in one.encode_batch(some)], pa.list_(pa.int32()))

    return F.arrow_udf(encode, T.ArrayType(T.IntegerType()))(text)


def decode_column(df: DataFrame, path: str, ids: Column) -> Column:
    """The decoded text of an id column; null counts as no ids (empty text)."""
    model = _model(df, path)

    def decode(rows: pa.Array) -> pa.Array:
        one = codec(model.value)
        return pa.array([one.decode(ids or []) for ids in rows.to_pylist()], pa.string())

    return F.arrow_udf(decode, T.StringType())(ids)


_DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids.  A very long text is one batch of its own;
    memory and time grow with its length.  Repeated rows get a row each and null
    ids stay null; an empty table gives an empty result; other columns, whatever
    their names, play no part.
    """
    model = _model(docs, path)

    def digest(texts: pa.Array) -> pa.Array:
        rows = _digests(codec(model.value), texts)
        n, ids, decoded = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                           pa.array(decoded, pa.string())], names=_DIGEST.names)

    d = free_name(docs, "round_trip")
    return docs.select(F.col(id_col), F.arrow_udf(digest, _DIGEST)(F.col(text_col)).alias(d)).select(id_col, f"{d}.*")
