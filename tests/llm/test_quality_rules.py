import re
from collections import defaultdict

import numpy as np
from edge import PROSE, SCHEMA, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from credit_signals.llm import quality_rules as q


def brute(text):
    w = words(text)

    def cover(n):
        at = defaultdict(list)
        for i in range(len(w) - n + 1):
            at[tuple(w[i:i + n])].append(i)
        return {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + n)}

    seen, dup, points = set(), 0, 0
    for line in (text or "").split("\n"):
        if words(line):
            if line in seen:
                dup += 1
                points += sum(map(len, words(line)))
            seen.add(line)
    total = sum(map(len, w))
    share = [sum(len(w[i]) for i in cover(n)) / total if total else 0.0 for n in q.LENGTHS]
    return (len(w), total, len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover(8)),
            points / total if total else 0.0, *share)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n\t#|", max_size=160))
def test_measures_against_brute_force(text):
    got, want = q.measure(text.encode()), brute(text)
    assert got[:5] == want[:5]
    np.testing.assert_allclose(got[5:], want[5:])


def test_colliding_hashes_are_told_apart():
    ids = np.arange(40) % 13
    equal = q.covered(ids, q.rolling(ids, (5,))[5], 5)
    assert (q.covered(ids, np.zeros(36, np.uint64), 5) == equal).all()
    distinct = np.arange(40)
    assert not q.covered(distinct, np.zeros(36, np.uint64), 5).any()


def test_rows_and_verdicts(spark):
    docs = documents(spark)
    rows = {(r.doc_id, r.n_words): r for r in q.judge(docs).collect()}
    for r in docs.collect():
        want = brute(r.text)
        got = rows[(r.doc_id, want[0])]
        assert tuple(got)[1:6] == want[:5]
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert got.base_failed == failed and not (failed and got.kept)
    assert rows[(1, len(words(PROSE)))].kept
    assert q.judge(docs).count() == docs.count()


def test_keep_is_the_verdict_and_keeps_columns(spark):
    docs = documents(spark)
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == q.judge(docs).where("kept").count()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert q.judge(empty).count() == 0 and q.keep(empty).count() == 0
