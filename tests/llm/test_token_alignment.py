import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from edge import SCHEMA, documents
from tokenizers import Tokenizer

from credit_signals.llm import queries
from credit_signals.llm import token_alignment as ta
from credit_signals.llm.bpe_automaton import byte_alphabet, split_patterns
from credit_signals.llm.queries import tokenizer_path

BYTES, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTES)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ALPHABET = byte_alphabet()


@pytest.fixture(scope="module")
def aligner():
    with open(BYTES, "rb") as spec, open(PIECES, "rb") as model:
        return ta.Aligner((spec.read(), split_patterns()), model.read())


def spans(parts):
    at = 0
    for p in parts:
        yield at, at + len(p)
        at += len(p)


def brute(text):
    """(n_a, n_b, n_groups, n_links, groups_sha256, {(a, b): links}) by comparing all spans."""
    text = text or ""
    a, b = A.encode(" " + text, add_special_tokens=False), B.encode(text)
    left = [bytes(ALPHABET[c] for c in t) for t in a.tokens]
    right = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = b" " + text.encode()
    if not text or b"".join(left) != want or b"".join(right) != want:
        return 0, 0, 0, 0, "", {}
    ids_a = a.ids
    sa, sb, links, from_b = list(spans(left)), list(spans(right)), Counter(), 0
    for i, (s, e) in enumerate(sa):
        while sb[from_b][1] <= s:
            from_b += 1
        j = from_b
        while j < len(sb) and sb[j][0] < e:
            links[ids_a[i], b[j]] += 1
            j += 1
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    owner = {e: i for i, e in enumerate(ends)}
    groups = [([], []) for _ in ends]
    for side, ids, cut in ((0, ids_a, sa), (1, b, sb)):
        group = 0
        for i, (_, e) in zip(ids, cut):
            groups[group][side].append(i)
            group = owner[e] + 1 if e in owner else group
    text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return len(ids_a), len(b), len(ends), sum(links.values()), hashlib.sha256(text.encode()).hexdigest(), dict(links)


def row(one, r):
    return (*r[:5], {(int(p) // one.windows.b_ids, int(p) % one.windows.b_ids): int(k) for p, k in zip(r[5], r[6])})


def texts(n, seed):
    rng = random.Random(seed)
    signs = ["a", "b", " ", "  ", " the", "ing", "\n", "\t", "'s", "1", "é", "½", "²", "一", "🙂", "_", ".", "<s>", "\x00", " ",
             "﻿", "<|endoftext|>", "ﬁ"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return out + ["▁x", "a ▁ b", " ", "x", " x", "\n", "  ", "", "x" * 5000, " " * 3000, "word " * 2000]


def test_rows_equal_brute_force(aligner):
    some = texts(1500, 1)
    assert [row(aligner, r) for r in aligner.rows(some)] == [brute(t) for t in some]


def test_kept_windows_are_bounded(aligner, monkeypatch):
    monkeypatch.setattr(ta, "KEPT_WINDOWS", 5)
    some = texts(60, 2)
    for at in range(0, 60, 20):
        part = some[at:at + 20]
        assert [row(aligner, r) for r in aligner.rows(part)] == [brute(t) for t in part]
        assert len(aligner.windows.known) <= 5


def corpus(rows):
    """The whole result by plain code."""
    found = [(i, brute(t)) for i, t in rows]
    total, most = Counter(), Counter()
    for _, r in found:
        total.update(r[5])
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return Counter((i, *r[:4], sum(k for p, k in r[5].items() if total[p] == most[p[1]]),
                    sum(k * total[p] for p, k in r[5].items()), r[4]) for i, r in found)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 40, 1])
def test_documents(spark, broadcast_pairs):
    docs = documents(spark)
    got = ta.align(docs, BYTES, PIECES, broadcast_pairs=broadcast_pairs)
    assert got.columns == COLUMNS
    assert Counter(tuple(r) for r in got.collect()) == corpus([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert ta.align(spark.createDataFrame([], SCHEMA), BYTES, PIECES).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op13_token_alignment(spark, sf)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert Counter(tuple(r) for r in got.collect()) == corpus(rows)


def test_lists_of_nothing():
    assert ta._lists([(), ()], pa.int64()).to_pylist() == [[], []]


def test_windows_are_encoded_once(aligner, monkeypatch):
    some = ["seldom words stand here twice, seldom words", "and here\nseldom words stand"] * 3
    want = [brute(t) for t in some]
    assert [row(aligner, r) for r in aligner.rows(some)] == want
    pieces, encoded = aligner.pieces, []

    class Spy:
        def encode(self, texts, **kw):
            encoded.extend(texts)
            return pieces.encode(texts, **kw)

    monkeypatch.setattr(aligner, "pieces", Spy())
    assert [row(aligner, r) for r in aligner.rows([*some, "seldom words stand anew"])] == [*want, brute("seldom words stand anew")]
    assert encoded == ["anew"]


def test_windows_at_all_white_space(aligner):
    rng = random.Random(5)
    signs = ["a", "'s", "1", "!", " ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028",
             "\u202f", "\u3000", "\u200b", "\u2581", "the", "\U0001f642", "\u0661"]
    some = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(1500)]
    some += [a + b + c for a in signs for b in signs for c in ("", " ", "a")]
    assert [row(aligner, r) for r in aligner.rows(some)] == [brute(t) for t in some]
    assert [row(aligner, next(aligner.rows([t]))) for t in some[:300]] == [brute(t) for t in some[:300]]
