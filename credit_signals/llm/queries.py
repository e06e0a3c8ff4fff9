"""Driver queries of the operators, one ``opN_<name>`` each, over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_automaton, chat, classifier, exact_dedup, html_extract, mixing, pii, quality_rules, sentencepiece_codec,
               simhash, spelling, token_alignment, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = classifier.train(docs, _table(spark, sf_dir, "labels"))
    return classifier.score(docs, machine)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(_table(spark, sf_dir, "documents"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


CONTROL_CASE = r"\### Assistant: </turn> ok"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_CASE), (-7, 1, "assistant", CONTROL_CASE)],
                                  "conv_id long, turn long, role string, text string")
    return chat.format_digests(rows.unionByName(extra), tokenizer_path("byte_bpe_50k.json")) \
        .drop("n_tokens", "loss_tokens")


def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(_table(spark, sf_dir, "documents"), shortest=6, fewest=5, ratio=5, noise=199)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_quality_rules, op3_simhash, op4_source_mixing, op5_quality_classifier,
                                   op6_sentencepiece, op7_html_extraction, op8_pii, op9_url_filters,
                                   op10_chat_formatting, op11_bpe_automaton, op12_spelling_variants,
                                   op13_token_alignment)}

OP1_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

OP9_SQL = r"""
WITH u AS (SELECT page_id,
             CASE WHEN strpos(url, '://') = 0 OR url IS NULL THEN '' ELSE
               translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
             CASE WHEN strpos(url, '://') = 0 OR url IS NULL THEN '' ELSE
               regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
           FROM pages),
     r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                          ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
     f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
           FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (page_id)
"""

OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL
           SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
     e AS (SELECT *, length(role) + length(text) + 20
                   + length(text) - length(replace(text, '\', ''))
                   + (length(text) - length(replace(text, '<turn>', ''))) // 6
                   + (length(text) - length(replace(text, '<text>', ''))) // 6
                   + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS formatted FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

# CRC-32 over the UTF-8 bytes of Latin text; near words meet at the texts that one deletion leaves
OP12_SQL = r"""
WITH RECURSIVE tab AS MATERIALIZED (
       SELECT list(t ORDER BY i) AS tab FROM (
         SELECT i, list_reduce([i] || range(8)::BIGINT[], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                                                                       ELSE a >> 1 END) AS t FROM range(256) r(i))),
     runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
     typed AS (SELECT run, k, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(
                     string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                     lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c) - 64] END)),
                     lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h
               FROM (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY doc_id, run), tab),
     v AS MATERIALIZED (
       SELECT word, sum(k)::BIGINT AS n FROM (
         SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                     ELSE run END AS word, k FROM typed)
       WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
     d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
           FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
     near AS (SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
              UNION SELECT a.word, b.word, b.n FROM v a JOIN d b ON a.word = b.cut
              UNION SELECT b.word, a.word, a.n FROM v a JOIN d b ON a.word = b.cut),
     best AS (SELECT word, count(*) AS n_near, max(m) AS m, first(other ORDER BY m DESC, other) AS other FROM near GROUP BY word),
     f AS MATERIALIZED (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form,
                               CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
     r AS (SELECT word, coalesce(form, word) AS root, 0 AS depth FROM f
           UNION ALL SELECT r.word, f.form, depth + 1 FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM r GROUP BY word)
USING (word)
"""

ORACLE_SQL = {"op1_exact_dedup": OP1_SQL, "op9_url_filters": OP9_SQL, "op10_chat_formatting": OP10_SQL,
              "op12_spelling_variants": OP12_SQL}
