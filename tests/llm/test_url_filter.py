import re
from collections import Counter

from pyspark.sql import functions as F

from credit_signals.llm import url_filter as u

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
         ("block", "Net", "/fr/"), ("block", "exact.org", "/a?b"), ("allow", "org", ""), ("block", "deep.org", "/a/b/c"),
         ("allow", "tie.io", "/ab"), ("block", "io", "/ab/cd"), ("allow", "a.io", "/ab/c")]
URLS = [None, "", "no scheme", "://", "http://", "https://Example.COM/en/x", "http://www.example.com/en/?q=1", "http://www.example.com/EN/",
        "http://example.com", "http://example.com/", "http://a.net/es/1#t", "http://a.net/fr", "http://net/fr/x", "ftp://x.notnet/es/", "http://deep.org/a/b/cd",
        "http://deep.org/a/b", "http://x.y.z.deep.org/a/b/c?x", "http://exact.org/a?b", "http://org?x", "http://a://b.com/", "http://tie.io/ab/cd",
        "http://a.io/ab/cd", "http://é.com/ü", "http://com..com//", "x\n://n.com/\ny", "http://" + "a." * 300 + "com/" + "p/" * 2000,
        "http://user@example.com:80/en/"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3:])
        host, path = "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]
    fits = [(len(h + p), v == "block", h.lower() + p, v) for v, h, p in RULES
            if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_rows(spark):
    rows = [(i if i % 9 else None, url) for i, url in enumerate(URLS)] + [(3, URLS[5])] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for c in ("id", "host", "path", "rule", "verdict", "short"):
        pages = pages.withColumn(c, F.lit("clash"))
    got = u.judge_urls(pages.repartition(3), u.rule_table(spark, RULES))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *brute(url)) for i, url in rows)
    assert u.judge_urls(pages.limit(0), u.rule_table(spark, RULES)).count() == 0


def test_no_rules_and_default(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = u.rule_table(spark, RULES).limit(0)
    assert tuple(u.judge_urls(pages, none, default="block").first())[3:] == (None, "block")


def test_no_python_and_no_forced_broadcast_of_data(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = u.judge_urls(pages, u.rule_table(spark, RULES))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_very_long_host_and_path_are_judged_in_time(spark):
    import time
    from credit_signals.llm.queries import URL_RULES
    rows = [(1, "http://" + "a." * 100_000 + "example.com/en/x"), (2, "http://x.net" + "/fr/" + "p/" * 200_000),
            (3, "http://" + "b." * 100_000 + "org/"), (4, "http://" + "." * 50_000 + "www.example.com/en/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    begun = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in u.judge_urls(pages, u.rule_table(spark, URL_RULES)).collect()}
    assert got == {1: ("example.com/en/", "block"), 2: ("net/fr/", "block"), 3: (None, "allow"), 4: ("www.example.com/en/", "allow")}
    assert time.time() - begun < 20


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert u.judge_urls(pages, u.rule_table(spark, [("block", "x", "y")]).limit(0)).first().verdict == "allow"
