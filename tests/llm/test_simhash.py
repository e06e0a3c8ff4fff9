import random
from collections import Counter

import pytest
import xxhash
from edge import SCHEMA, documents, words
from pyspark.sql import functions as F

from credit_signals.llm import simhash
from credit_signals.llm.components import components


def brute_print(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    n = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if near(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    roots = classes({fp for _, fp in rows}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, fp in rows:
        if i is not None:
            least[roots[fp]] = min(i, least.get(roots[fp], i))
    want = Counter((i, f"{fp:016x}", least.get(roots[fp])) for i, fp in rows)
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want


def test_spark_hash_is_the_same(spark):
    h = spark.sql("select xxhash64('a b c') as h").first().h
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("limit", [2, 64])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_find_the_same_components_on_short_and_long_lists(spark, bits, limit):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (2**64 - 1) for b in base for _ in range(25)}
    prints = {p & (2**64 - 1) for p in prints} | {0, 1, 3, 2**64 - 1}
    signed = {p - 2**64 if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.vertex: r.root for r in components(simhash.links(frame, bits, limit)).collect()}
    want = classes(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= bits)
    assert {p: got.get(p, p) for p in signed} == want


def test_drop_leaves_one_row_per_component(spark):
    docs = documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    found = simhash.near_duplicates(docs)
    named = {r.component_id for r in found.where("component_id is not null").collect()}
    nameless = found.where("component_id is null").select("fingerprint").distinct().count()
    assert sorted(i for i in ids if i is not None) == sorted(named)
    assert ids.count(None) == nameless


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    hub = spark.range(1001, 1500).select(F.lit(1000).cast("long").alias("u"), F.col("id").alias("v"))
    loops = spark.range(5).select(F.col("id").alias("u"), F.col("id").alias("v"))
    got = {r.vertex: r.root for r in components(chain.union(hub).union(loops)).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1500)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
