r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the
sorted spans of its turns are intersected with the sorted token spans by binary
search; the tokens inside assistant texts are under the loss mask.

The template is ``<turn>ROLE<text>TEXT</turn>`` per turn, one per line.  Control
strings inside roles and texts are escaped: a backslash is doubled, and one is
put after the ``<`` of a control string, so none of the three can occur in
them.  The control strings are tokens of their own, therefore no token crosses
the edge of a text, and a conversation that is longer than ``segment_chars`` characters
may be cut after any ``</turn>`` without changing a token.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

OPEN, TEXT, CLOSE = "<turn>", "<text>", "</turn>"
SEGMENT = 1 << 20                # characters of a conversation that are held and encoded at a time
_CONTROL = re.compile(r"\\|<(?=/?turn>|text>)")
_TURN = re.compile(r"<turn>(.*?)<text>(.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\g<0>\\", text) if "\\" in text or "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"(\\)\\|(<)\\", lambda m: m[1] or m[2], text) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
    """The formatted text of (role, text) turns, and the span of each turn's text with its loss flag."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role == "assistant"))
        parts += (head, body, CLOSE, "\n")
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text: the inverse of ``render``."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def chat_tokenizer(model: str):
    """The byte-level tokenizer in the JSON text ``model`` with the control strings as its only special tokens."""
    from tokenizers import AddedToken, Tokenizer

    spec = json.loads(model)
    spec["added_tokens"], spec["post_processor"] = [], None      # such strings in a text are ordinary text
    spec["pre_tokenizer"]["trim_offsets"] = False                # a token's span keeps its leading space
    tokenizer = Tokenizer.from_str(json.dumps(spec))
    tokenizer.add_special_tokens([AddedToken(s, normalized=False, special=True) for s in (OPEN, TEXT, CLOSE)])
    return tokenizer


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int, bool]]) -> np.ndarray:
    """Which tokens lie in a span with the loss flag; both inputs are sorted."""
    mask = np.zeros(len(offsets), bool)
    flagged = np.array([(a, z) for a, z, loss in spans if loss and z > a], np.int64).reshape(-1, 2)
    if len(offsets) and len(flagged):
        first = np.searchsorted(offsets[:, 1], flagged[:, 0], side="right")
        past = np.searchsorted(offsets[:, 0], flagged[:, 1], side="left")
        for a, z in zip(first.tolist(), past.tolist()):
            mask[a:z] = True
    return mask


def masked_pieces(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> Iterator[str]:
    """The characters under the mask, each once (tokens of one character share its span)."""
    end = 0
    for a, z in offsets[mask].tolist():
        if z > max(a, end):
            yield formatted[max(a, end):z]
            end = z


@dataclass
class _Digest:
    """What is read back from one conversation's output, segment by segment."""

    conv_id: object
    n_turns: int = 0
    n_tokens: int = 0
    loss_tokens: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def add(self, held: list[tuple[str, str]], tokenizer) -> None:
        formatted, spans = render(held)
        encoded = tokenizer.encode(formatted)
        offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        mask = loss_mask(offsets, spans)
        back = parse(formatted)
        if back != held:
            raise ValueError("a formatted conversation was not read back as it was")
        for role, text in back:
            self.turns.update(f"{role}\n{text}\n".encode())
        loss = unescape("".join(masked_pieces(formatted, offsets, mask)))
        self.loss.update(loss.encode())
        self.n_turns += len(back)
        self.n_tokens += len(offsets)
        self.loss_tokens += int(mask.sum())
        self.loss_chars += len(loss)
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars, self.n_tokens, self.loss_tokens)


def _fields(kind: T.DataType, id_col: str) -> T.StructType:
    kinds = {"n_turns": T.LongType(), "turns_sha256": T.StringType(), "loss_chars": T.LongType(),
             "loss_sha256": T.StringType(), "formatted_chars": T.LongType(), "n_tokens": T.LongType(),
             "loss_tokens": T.LongType()}
    return T.StructType([T.StructField(id_col, kind), *[T.StructField(n, k) for n, k in kinds.items()]])


def _in_order(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    ship(turns.sparkSession)
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")


def format_digests(turns: DataFrame, tokenizer_path: str, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", segment_chars: int = SEGMENT) -> DataFrame:
    """One row per conversation, read back from its formatted and masked output.

    Rows of a conversation are ordered by turn (null first), then role and text;
    repeated rows count as often as they occur.  Null roles and texts count as
    empty, rows with a null id form one conversation.  A conversation streams
    through one task in segments, because its digest needs its order; memory is
    bounded by ``segment_chars`` and the longest turn.  An empty table gives an empty
    result; other columns of ``turns`` play no part.
    """
    rows = _in_order(turns, id_col, turn_col, role_col, text_col)
    with open(tokenizer_path, encoding="utf-8") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())
    schema = _fields(turns.schema[id_col].dataType, id_col)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, tokenizer = to_arrow_schema(schema), chat_tokenizer(model.value)
        now, held, size, out = None, [], 0, []
        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        now.add(held, tokenizer)
                        out.append(now.row())
                    now, held, size = _Digest(conv_id), [], 0
                elif size >= segment_chars:
                    now.add(held, tokenizer)
                    held, size = [], 0
                held.append((role, text))
                size += len(role) + len(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if now is not None:
            now.add(held, tokenizer)
            yield pa.RecordBatch.from_arrays([pa.array([v], k.type) for v, k in zip(now.row(), arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def format_segments(turns: DataFrame, tokenizer_path: str, id_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text", segment_chars: int = SEGMENT) -> DataFrame:
    """The training rows themselves: (id, segment, formatted, ids, mask), segments of whole turns in order.

    The concatenation of a conversation's segments is its formatted text and its
    token sequence.  Nulls, ties, repeated rows and empty tables as above.
    """
    rows = _in_order(turns, id_col, turn_col, role_col, text_col)
    with open(tokenizer_path, encoding="utf-8") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([T.StructField(id_col, turns.schema[id_col].dataType), T.StructField("segment", T.LongType()),
                           T.StructField("formatted", T.StringType()), T.StructField("ids", T.ArrayType(T.LongType())),
                           T.StructField("mask", T.ArrayType(T.BooleanType()))])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, tokenizer = to_arrow_schema(schema), chat_tokenizer(model.value)

        def one(conv_id, segment, held):
            formatted, spans = render(held)
            encoded = tokenizer.encode(formatted)
            mask = loss_mask(np.array(encoded.offsets, np.int64).reshape(-1, 2), spans)
            values = (conv_id, segment, formatted, encoded.ids, mask.tolist())
            return pa.RecordBatch.from_arrays([pa.array([v], k.type) for v, k in zip(values, arrow)], schema=arrow)

        now, segment, held, size = None, 0, [], 0
        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (now != conv_id or size >= segment_chars):
                    yield one(now, segment, held)
                    segment, held, size = (segment + 1 if now == conv_id else 0), [], 0
                now = conv_id
                held.append((role, text))
                size += len(role) + len(text)
        if held:
            yield one(now, segment, held)

    return rows.mapInArrow(run, schema)
