import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import SCHEMA, documents, normalised

from credit_signals.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append((i, t or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1]), r[0] is None, r[0]))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for i, t in members:
            out.append((i, best[0] if len(members) > 1 else i, len(members),
                        len(members) == 1 or (i == best[0] and len(t) == len(best[1])), sha))
    return Counter(out)


def test_against_brute_force(spark):
    docs = documents(spark)
    got = Counter(tuple(r) for r in exact_dedup.mark_duplicates(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_full_routing_bitmap_changes_nothing(spark):
    docs = documents(spark)
    wide = exact_dedup.mark_duplicates(docs).collect()
    narrow = exact_dedup.mark_duplicates(docs, routing_bits=9).collect()
    assert Counter(map(tuple, wide)) == Counter(map(tuple, narrow))


def test_drop_leaves_one_row_per_text_with_all_columns(spark):
    docs = documents(spark)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(normalised(r.text) for r in rows) == Counter({normalised(r.text) for r in docs.collect()})
    assert {r.doc_id for r in rows if normalised(r.text).startswith("Thequick") and "indeed" not in r.text
            and "A line" not in r.text} == {15}          # the longest original


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.mark_duplicates(empty).count() == 0
    assert exact_dedup.drop_duplicates(empty).count() == 0


@pytest.mark.parametrize("bits", [0, 3, 11])
def test_filters_merge_without_loss(spark, bits):
    rng = np.random.default_rng(bits)
    values = np.concatenate([rng.integers(-2**63, 2**63, 500), rng.integers(0, 5, 300), [-1, -1, 2**63 - 1, -2**63, -2**63]])
    fps = spark.createDataFrame([(int(v),) for v in values], "fp long").repartition(5)
    merged = exact_dedup.merged_counts(exact_dedup.partition_filters(fps, bits), bits)
    want = {v: n for v, n in Counter(values.tolist()).items() if n > 1}
    assert {r.fp: r.n for r in merged.collect()} == want
