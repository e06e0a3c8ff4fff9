import zlib

import numpy as np
from edge import SCHEMA, documents

from credit_signals.llm import classifier as c

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    size, wide = c.BUCKETS + 3, 3
    m = c.Machine(0.3, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, c.FACTORS)).astype(np.float32),
                  np.zeros(wide), np.ones(wide))
    buckets, values = [np.array([5, 9, 5], np.int32), np.array([], np.int32)], [np.array([.5, 1, 2], np.float32), np.array([], np.float32)]
    dense = rng.normal(size=(2, wide))
    index, value, starts = m.rows(buckets, values, dense)
    logits, _ = m.logits(index, value, starts)
    for row, (a, z) in enumerate(zip(starts, [*starts[1:], len(index)])):
        i, x = index[a:z], value[a:z]
        pairs = sum(float(m.factors[i[p]] @ m.factors[i[q]]) * x[p] * x[q] for p in range(len(i)) for q in range(p + 1, len(i)))
        assert abs(logits[row] - (0.3 + float(m.linear[i] @ x) + pairs)) < 1e-3


def test_held_out_accuracy_on_given_tables(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = c.score(docs, c.train(docs, labels)).join(labels, "doc_id").collect()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    test = [r for r in scored if r.held_out]
    bad, good = [r.score for r in test if r.quality == 0], [r.score for r in test if r.quality == 1]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([r.predicted == r.quality for r in test]) > 0.93


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality", "toxic")
    one, two = c.train(docs, labels), c.train(docs, flipped)
    assert one.bias == two.bias and (one.linear == two.linear).all() and (one.factors == two.factors).all()


def test_only_text_and_metadata_count(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    machine = c.train(docs, labels, sample_rows=100)
    other = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'yy' as source", "n_chars")
    a = {r.doc_id: r.score for r in c.score(docs, machine).collect()}
    b = {r.doc_id - 1_000_000: r.score for r in c.score(other, machine).collect()}
    assert a == b


def test_awkward_rows_and_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (13, 1), (17, 0), (18, 0), (None, 1), (4, None), (999, 1), (10, 1), (11, 0)],
                                   "doc_id long, quality int")
    scored = c.score(docs, c.train(docs, labels))
    assert scored.count() == docs.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert scored.where("doc_id is null and held_out").count() == 0
    for few in (labels.limit(0), labels.where("quality = 1")):
        assert c.score(docs, c.train(docs, few)).where("score between 0.4 and 1").count() == docs.count()
    empty = spark.createDataFrame([], SCHEMA)
    assert c.score(empty, c.train(empty, labels)).count() == 0
