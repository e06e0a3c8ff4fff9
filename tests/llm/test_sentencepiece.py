import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from edge import SCHEMA, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credit_signals.llm import sentencepiece_codec as sc
from credit_signals.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
with open(PATH, "rb") as file:
    MODEL = file.read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def codec():
    return sc.Codec(MODEL)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" ▁abehinrst.\n0ｆé日<s>/", max_size=60)))
def test_encoding_and_decoding_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    one = sc.codec(MODEL)
    ids = LIBRARY.encode(text)
    assert one.encode(text) == ids
    assert one.decode(ids) == LIBRARY.decode(ids)


def test_decoding_of_any_ids(codec):
    rng = random.Random(1)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999), 28705]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids) == LIBRARY.decode(ids)


def test_table_equals_the_definition(codec):
    rng = random.Random(2)
    pieces = [p for p in codec.id if len(p) < 6]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5)))
        assert [codec.pieces[i] for i in codec._by_table(text)] == codec.merge(text)


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(sc, "CACHED_UNITS", 3)
    monkeypatch.setattr(sc, "PAIR_BITS", 2)
    one = sc.Codec(MODEL)
    texts = ["many different words go through a very small cache", "and ▁ come back ▁x the same\x00 words é again " + "▁y" * 70] * 2
    for text in texts:
        assert one.encode_batch([text]) == [(",".join(map(str, LIBRARY.encode(text))), LIBRARY.decode(LIBRARY.encode(text)))]
        assert len(one.known) <= 3 and all(len(name) <= sc.LONGEST_CACHED for name in one.changed)


def test_batches_equal_single_texts(codec):
    rng = random.Random(4)
    texts = ["".join(rng.choice([" ", "▁", "the", "\n", "é", "日", "\x00", "🎉", "ing", "  "]) for _ in range(rng.randint(0, 25)))
             for _ in range(800)]
    for (ids, decoded), text in zip(codec.encode_batch(texts), texts):
        want = LIBRARY.encode(text)
        assert sc.numbers(ids) == want and decoded == LIBRARY.decode(want)


def test_rows(spark):
    docs = documents(spark)
    want = Counter()
    for r in docs.collect():
        ids = LIBRARY.encode(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in sc.round_trip(docs, PATH).collect()) == want
    assert sc.round_trip(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_columns(spark):
    docs = documents(spark)
    ids = docs.withColumn("ids", sc.encode_column(docs, PATH, F.col("text")))
    back = ids.withColumn("back", sc.decode_column(ids, PATH, F.col("ids")))
    for r in back.collect():
        assert r.ids == LIBRARY.encode(r.text or "") and r.back == LIBRARY.decode(r.ids)


def test_batches_take_bounded_memory():
    import pyarrow as pa

    class Sizes:
        def __init__(self):
            self.seen = []

        def encode_batch(self, texts):
            self.seen.append(sum(map(len, texts)))
            return [("1", t) for t in texts]

    one, texts = Sizes(), ["x" * 9_999] * 200 + [None, "", "y" * 1_200_000, "z"]
    rows = sc._digests(one, pa.array(texts))
    assert [r[0] for r in rows] == [1] * len(texts)
    assert max(n for n in one.seen if n < 1_200_000) < 510_000 and sum(one.seen) == sum(len(t or "") for t in texts)
