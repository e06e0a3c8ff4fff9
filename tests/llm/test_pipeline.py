import sentencepiece
from edge import SCHEMA, documents
from test_exact_dedup import brute as exact_groups
from test_quality_rules import brute as measures
from test_simhash import brute_print, classes

import corpus_pipeline
from credit_signals.llm import mixing, quality_rules
from credit_signals.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def keeps(text):
    m = measures(text)
    limits = quality_rules.RepetitionLimits()
    return not (m[0] < limits.min_words or 100 * m[4] > limits.max_repeat_words_pct * m[0] or m[5] > limits.max_line_share
                or any(s > most for s, most in zip(m[6:], limits.max_ngram_share)) or m[2] > limits.max_symbols_per_word * m[0])


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "sentencepiece"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {i for i, t in rows.items() if keeps(t)}
    at = corpus_pipeline.quality(spark, docs, SF)
    assert at.columns == docs.columns and {r.doc_id for r in at.collect()} == kept
    kept = {r[0] for r in exact_groups([(i, rows[i]) for i in kept]) if r[3]}
    at = corpus_pipeline.exact(spark, at, SF)
    assert at.columns == docs.columns and sorted(r.doc_id for r in at.collect()) == sorted(kept)
    prints = {i: brute_print(rows[i]) for i in kept}
    roots = classes(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    at = corpus_pipeline.near(spark, at, SF)
    assert at.columns == docs.columns and sorted(r.doc_id for r in at.collect()) == sorted(least.values())
    drawn = {r.doc_id for r in mixing.mix(at).where("selected").collect()}
    at = corpus_pipeline.mixture(spark, at, SF)
    assert at.columns == docs.columns and {r.doc_id for r in at.collect()} == drawn
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    out = corpus_pipeline.tokens(spark, at, SF).collect()
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(library.encode(rows[i])) for i in drawn}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, out))


def test_awkward_rows_go_through(spark, tmp_path):
    docs = documents(spark)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if n + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{n}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}"))
    assert out.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_all_queries_and_their_sql(spark):
    from compare import compare, duck
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    con = duck(SF)
    for name, sql in ORACLE_SQL.items():
        assert compare(QUERIES[name](spark, SF), con, sql) is None
