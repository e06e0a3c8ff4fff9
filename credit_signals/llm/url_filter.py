"""URL rules by host suffix and path prefix.

A URL stands for a set of expressions: each suffix of its host with as many
labels as some rule's host, followed by each prefix of its path that is as long
as some rule's path.  A rule fits exactly when it is one of these expressions, so the work is
an equi-join: on a short prefix of the expressions' hash first, then on the
full digest.  The longest rule that fits decides.

All steps are DataFrame operations on distinct (host, path) pairs: a URL that
many pages share is expanded once, and a host with a third of the pages is
spread over its paths.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_PREFIX = 8                  # hex digits of the digest that the join compares


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table; the host is compared in lower case, the path as it is."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _labels(host: str) -> Column:
    return F.char_length(host) - F.char_length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1


def _decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) pairs that a rule fits."""
    known = rules.select(F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict") \
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path"))) \
        .withColumn("short", F.substring("digest", 1, HASH_PREFIX))
    # what lengths rules have: no more of them than the longest rule has labels and characters
    counts = known.agg(F.collect_set(F.char_length("rule_path")), F.collect_set(_labels("rule_host"))).first()
    lengths, label_counts = (F.array(*[F.lit(n) for n in sorted(some)]).cast("array<int>") for some in counts)
    suffixes = F.transform(F.filter(label_counts, lambda n: n <= _labels("host")),
                           lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.char_length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    asked = urls.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes")) \
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix")) \
        .withColumn("asked", _digest(F.col("suffix"), F.col("prefix"))) \
        .select("host", "path", "asked", F.substring("asked", 1, HASH_PREFIX).alias("short"))
    rule = F.concat("rule_host", "rule_path")
    fits = asked.join(known, "short").where(F.col("asked") == F.col("digest"))
    best = F.max(F.struct(F.char_length(rule).alias("n"), (F.col("verdict") == "block").alias("blocks"),
                          rule.alias("rule"), F.col("verdict")))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (null if none fits), verdict.

    A null URL, or one without ``://``, has an empty host and path, which no
    rule with a host fits.  Work on a very long host or path is linear in it, for
    each length that rules have.  Of rules of one length a blocking one wins, then the
    greater rule string.  Repeated rows get a row each; null ids stay null; an
    empty table gives an empty result; other columns of ``pages`` play no part.
    """
    parts = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"))
    decided = _decide(parts.select("host", "path").distinct(), rules)
    return parts.join(decided, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
