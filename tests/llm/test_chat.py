import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credit_signals.llm import chat
from credit_signals.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as file:
    MODEL = file.read()
PIECES = st.lists(st.sampled_from(["<turn>", "</turn>", "<text>", "\\", "<", "/", "turn>", " ", "\n", "é", "日", "🎉", "ok", "#",
                                   "<|endoftext|>", "\x00", "  "]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
def test_rendering_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:z]) for a, z, _ in spans] == [t for _, t in turns]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), PIECES), max_size=5))
def test_mask_covers_exactly_the_assistant_texts(turns):
    tokenizer = chat.chat_tokenizer(MODEL)
    formatted, spans = chat.render(turns)
    offsets = np.array(tokenizer.encode(formatted).offsets, np.int64).reshape(-1, 2)
    mask = chat.loss_mask(offsets, spans)
    assert chat.unescape("".join(chat.masked_pieces(formatted, offsets, mask))) == "".join(t for r, t in turns if r == "assistant")
    inside = [any(loss and a < z2 and a2 < z for a, z, loss in spans) for a2, z2 in offsets.tolist()]
    assert mask.tolist() == inside


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (2, 1, "assistant", " b "), (2, 0, "user", None),
        (2, 1, "assistant", " a "), (2, 1, "assistant", " a "), (3, 0, None, ""), (None, 5, "assistant", "lost"), (None, None, "user", "x"),
        (4, 0, "assistant", "long text " * 20_000), (4, 1, "user", "<turn><text>")] + \
       [(5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(400)]


def conversations(spark, rows=ROWS):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("id", "segment", "formatted", "n_turns"):
        frame = frame.withColumn(c, F.lit("clash"))
    return frame.repartition(3)


def brute(rows):
    out = Counter()
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda k: (k[0], k[1] or 0, k[2], k[3]))
        turns = [(r, x) for _, _, r, x in mine]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[(conv, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss),
             hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)[0]))] += 1
    return out


@pytest.mark.parametrize("segment", [1, 1 << 20])
def test_rows(spark, segment):               # cutting a conversation changes nothing
    got = chat.format_digests(conversations(spark), PATH, segment_chars=segment).drop("n_tokens", "loss_tokens")
    assert Counter(tuple(r) for r in got.collect()) == brute(ROWS)


def test_segments_join_to_the_whole(spark):
    tokenizer = chat.chat_tokenizer(MODEL)
    rows = chat.format_segments(conversations(spark), PATH, segment_chars=500).orderBy("conv_id", "segment").collect()
    five = [r for r in rows if r.conv_id == 5]
    whole, _ = chat.render([(r, t) for _, _, r, t in ROWS[-400:]])
    assert "".join(r.formatted for r in five) == whole
    assert [i for r in five for i in r.ids] == tokenizer.encode(whole).ids
    assert all(len(r.ids) == len(r["mask"]) for r in rows)


def test_empty_table(spark):
    empty = conversations(spark).limit(0)
    assert chat.format_digests(empty, PATH).count() == 0 and chat.format_segments(empty, PATH).count() == 0
