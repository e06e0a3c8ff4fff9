import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from edge import SCHEMA, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from credit_signals.llm import bpe_automaton as ba
from credit_signals.llm import last_tokens as lt
from credit_signals.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
with open(PATH, "rb") as file:
    SPEC = file.read()
LIBRARY = Tokenizer.from_file(PATH)
CODEC = ba.ByteCodec(SPEC)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60),
                 st.text(alphabet="aab \n\t'sreallvd12é½²一〇Ⅷ́‍🙂_.,<|endoftext|>\x1c\x85\xa0﻿\x00", max_size=60)))
def test_encoding_and_decoding_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = library_ids(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_special_tokens_and_plain_reading():
    text = "a <|endoftext|><|endoftext|> b"
    assert CODEC.encode(text) == library_ids(text)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert ba.ByteCodec(SPEC, special=False).encode(text) == plain.encode(text, add_special_tokens=False).ids


def test_words_are_cut_as_the_library_cuts_every_character():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 400):
        text = "".join(f"b{chr(c)}1{chr(c)}." for c in points[at:at + 400])
        want = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert CODEC.units(text) == want


def test_decoding_of_any_ids():
    rng = random.Random(1)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 255), rng.randint(256, 50256)]) for _ in range(rng.randint(0, 8))]
        assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def dense(merges, base):
    """The same construction with every state written out: {state: {label: state}}."""
    arcs = [{b: 0 for b in base}]
    for u, v, w in merges:
        target = next(s[u] for s in arcs if u in s)
        assert all(s.get(u, target) == target for s in arcs)
        after = arcs[target][v]
        arcs.append({a: t for a, t in arcs[target].items() if a != v})
        copy = len(arcs) - 1
        for state in arcs:
            if u in state:
                state[u] = copy
        if u == v:
            after = target
        for state in arcs:
            if u in state:
                state[w] = after
    return arcs


def replay(word, merges):
    """The definition: each merge in order, from left to right."""
    for u, v, w in merges:
        out, i = [], 0
        while i < len(word):
            if word[i:i + 2] == [u, v]:
                out.append(w)
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out
    return word


def test_arcs_equal_the_written_out_automaton():
    rng = random.Random(3)
    for _ in range(60):
        labels = {i: bytes([97 + i]) for i in range(3)}
        merges, word = [], [rng.randrange(3) for _ in range(60)]
        while len(merges) < 12 and len(word) > 4:             # pairs as they occur, so no merge is idle
            at = rng.randrange(len(word) - 1)
            u, v = word[at:at + 2]
            if labels[u] + labels[v] in labels.values():
                break
            w = len(labels)
            labels[w] = labels[u] + labels[v]
            merges.append((u, v, w))
            word = replay(word, merges[-1:])
        one, arcs = ba.Automaton(labels, merges), dense(merges, range(3))
        for t in labels:
            state = next(s[t] for s in arcs if t in s)
            for w in labels:
                assert bool(one.arcs(np.array([t]), np.array([w]))[0]) == (w in arcs[state])
        for _ in range(40):
            text = [rng.randrange(3) for _ in range(rng.randint(1, 12))]
            tokens, _ = one.words.split([bytes(97 + i for i in text)])
            assert tokens.tolist() == replay(text, merges)


def test_a_merge_list_that_is_none_is_refused():
    with pytest.raises(ValueError):
        ba.Automaton({0: b"a", 1: b"b", 2: b"ab", 3: b"ba", 4: b"aba"}, [(0, 1, 2), (2, 0, 4), (2, 0, 4)])


def test_small_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(ba, "CACHED_UNITS", 3)
    one = ba.ByteCodec(SPEC)
    one.automaton.step = one.automaton.words.fits = lt.Memo(one.automaton.arcs, bits=2)
    texts = ["many different words go through a very small cache", "and come back, the same words, again"] * 3
    assert [ba.numbers(x) for x in one.encode_batch(texts)] == [library_ids(x) for x in texts]
    assert len(one.known) <= 3


def test_lookup_holds_every_key():
    keys = np.random.default_rng(1).choice(1 << 40, 5000, replace=False)
    table = lt.Lookup(keys, np.arange(5000))
    assert (table(keys) == np.arange(5000)).all()
    assert (table(keys + (1 << 41)) == -1).all()


def test_rows(spark):
    docs = documents(spark)
    want = Counter()
    for r in docs.collect():
        ids = library_ids(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in ba.round_trip(docs, PATH).collect()) == want
    assert ba.round_trip(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_columns(spark):
    docs = documents(spark)
    ids = docs.withColumn("ids", ba.encode_column(docs, PATH, F.col("text")))
    back = ids.withColumn("back", ba.decode_column(ids, PATH, F.col("ids")))
    for r in back.collect():
        assert r.ids == library_ids(r.text or "") and r.back == (r.text or "")


def test_the_vocabulary_is_the_published_kind():
    assert json.loads(SPEC)["model"]["type"] == "BPE" and len(set(CODEC.automaton.state.values())) > 10_000
