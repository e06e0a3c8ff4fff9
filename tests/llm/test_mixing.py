from collections import defaultdict

import numpy as np
import pytest
from edge import SCHEMA, documents, words

from credit_signals.llm import mixing


def brute_rake(cells, wants, keep, rounds, tolerance):
    """cells: {(source, lang, topic): tokens}; the same rounds in plain Python."""
    weight = {k: float(v) for k, v in cells.items()}
    for _ in range(rounds):
        before = dict(weight)
        for d in range(3):
            has = defaultdict(float)
            for k, w in weight.items():
                has[k[d]] += w
            for k in weight:
                factor = wants[d].get(k[d], 0) / has[k[d]] if has[k[d]] > 0 and k[d] in wants[d] else 0.0
                weight[k] = min(weight[k] * factor, cells[k] / keep)
        if max((abs(weight[k] / b - 1) for k, b in before.items() if b > 0), default=0) <= tolerance:
            break
    return weight


def cells_frame(spark, seed, n=60):
    rng = np.random.default_rng(seed)
    cells = {(f"s{rng.integers(6)}", f"l{rng.integers(4)}", f"t{rng.integers(5)}"): int(rng.integers(0, 5000)) for _ in range(n)}
    cells[("s0", "l0", "t0")] = 100_000
    return cells, spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens long")


@pytest.mark.parametrize("seed", [1, 2])
def test_raking_against_plain_python(spark, seed):
    cells, frame = cells_frame(spark, seed)
    total = sum(cells.values())
    wants = []
    for d in range(3):
        sums = defaultdict(int)
        for k, v in cells.items():
            sums[k[d]] += v
        powers = {k: v ** 0.7 for k, v in sums.items() if v}
        wants.append({k: total * p / sum(powers.values()) for k, p in powers.items()})
    targets = {d: mixing.tempered(frame, d, 0.7) for d in mixing.DIMENSIONS}
    got = {(r.source, r.lang, r.topic): r for r in mixing.rake(frame, targets, 0.4, rounds=5, tolerance=1e-6).collect()}
    want = brute_rake(cells, wants, 0.4, 5, 1e-6)
    for k, w in want.items():
        assert got[k].weight == pytest.approx(w, rel=1e-9, abs=1e-9)
        assert 0 <= got[k].probability <= 1


def test_marginals_hold_when_the_caps_leave_room(spark):
    cells, frame = cells_frame(spark, 3, 500)
    targets = {d: mixing.tempered(frame, d, 0.9) for d in mixing.DIMENSIONS}
    raked = mixing.rake(frame, targets, 0.1, rounds=15, tolerance=1e-4)
    rows = raked.collect()
    for d in mixing.DIMENSIONS:
        has = defaultdict(float)
        for r in rows:
            has[r[d]] += r.weight
        for t in targets[d].collect():
            assert has[t.level] == pytest.approx(t.share * sum(cells.values()), rel=0.01)


def test_given_shares_leave_the_rest_to_other_levels(spark):
    _, frame = cells_frame(spark, 4)
    shares = {r.level: r.share for r in mixing.given(frame, "lang", {"l0": 0.5, "absent": 0.2}).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares["l0"] == pytest.approx(0.5 / 0.8)


def test_rows(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and r.doc_id != 15}
    for r in rows:
        assert 0 <= r.probability <= 1
        if r.doc_id in texts:
            n = len(words(texts[r.doc_id]))
            assert r.n_tokens == n and r.topic == mixing.topic_of((texts[r.doc_id] or "").encode(), n)
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in rows if r.selected)
    assert mixing.mix(docs).collect() and sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, rows))


def test_drawn_share_follows_the_probability(spark):
    docs = documents(spark, [(i, f"some words of document number {i}") for i in range(4000)])
    rows = mixing.mix(docs, keep=0.4, alpha=1.0).collect()
    assert sum(r.selected for r in rows) / len(rows) == pytest.approx(0.4, abs=0.03)


def test_empty_table_and_topic_column(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.sample(empty).count() == 0
    docs = documents(spark)
    assert {r.topic for r in mixing.mix(docs, topic_col="lang").collect()} == {"en", ""}


def water_fill(has, share, drawn):
    """Draws per level by bisection on the rate."""
    low, high = 0.0, 1e18
    for _ in range(400):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(has[k], mid * share[k]) for k in has) < drawn else (low, mid)
    return {k: min(has[k], high * share[k]) for k in has}


@pytest.mark.parametrize("keep", [0.1, 0.5, 0.75, 0.95, 1.0])
def test_limits_are_water_filling(spark, keep):
    cells, frame = cells_frame(spark, 7, 200)
    for d, name in enumerate(mixing.DIMENSIONS):
        has = defaultdict(int)
        for k, v in cells.items():
            has[k[d]] += v
        has = {k: v for k, v in has.items() if v}
        rows = {r.level: r for r in mixing.limited(frame, name, mixing.tempered(frame, name, 0.3), keep).collect()}
        want = water_fill(has, {k: r.share for k, r in rows.items()}, keep * sum(has.values()))
        for k, r in rows.items():
            assert r.limit * keep * sum(has.values()) == pytest.approx(want[k], rel=1e-6)


def drawn_share(rows):
    return sum(r.n_tokens * r.probability for r in rows) / sum(r.n_tokens for r in rows)


def test_limited_marginals_hold_with_the_registered_parameters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert drawn_share(mixing.mix(docs).collect()) > 0.7
    for r in mixing.shares(docs).collect():
        assert r.reached == pytest.approx(r.limited, rel=0.15) or r.limited < 0.005


def test_a_rare_level_costs_the_others_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rare = docs.limit(1).selectExpr("-1L AS doc_id", "'five words in one language' AS text", "'xx' AS lang", "source", "n_chars")
    before = mixing.mix(docs).where("selected").count()
    after = mixing.mix(docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(rare)).where("selected").count()
    assert abs(after - before) <= 0.01 * before and before > 600


def test_shares_tell_target_limit_and_reached(spark):
    docs = documents(spark, [(i, f"some words of document number {i}") for i in range(200)])
    rows = mixing.shares(docs, targets={"source": {"s0": 0.8}}, keep=0.75).collect()
    by = {(r.dimension, r.level): r for r in rows}
    s0 = by["source", "s0"]
    assert s0.target == pytest.approx(0.8) and s0.limited < 0.8 and s0.reached == pytest.approx(s0.limited, rel=0.05)
    with pytest.warns(UserWarning, match="cannot all be met"):       # topics are fixed by the language column
        rows = mixing.shares(docs, topic_col="lang", targets={"lang": {"en": 0.9}, "topic": {"en": 0.1}}, keep=0.1).collect()
    assert any(r.reached < 0.9 * r.limited for r in rows)
