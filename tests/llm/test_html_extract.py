import random

import pytest
from pyspark.sql import functions as F

from credit_signals.llm import html_extract as h


def text(source):
    return " ".join(t for t, article, chrome in h.read_page(source).blocks if article and not chrome)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("<", ""), ("plain", ""), ("<article>a", "a"), ("<article><p>a<b>b</b>c<br>d</article>x", "abc d"),
    ("<ARTICLE><P>A &amp; B&nbsp;C &lt;i&gt; &#233;&eacute</P></ARTICLE>", "A & B C <i> éé"),
    ("<article><p>a<p>b<nav>menu</nav><footer>f</footer><aside>s</aside>c</article>", "a b c"),
    ("<article>a<script>if (a<b) '</p>'</script><style>p{}</style><!-- no -- > -->b</article>", "ab"),
    ("<article>a<div class='ad big'>buy<div>more</div></div><p class=cookie-notice>n<p>b</article>", "a b"),
    ("<article>a<section id=comments><article class=comment>hi</article></section>b</article>", "a b"),
    ("<article><header><h1>Title</h1><p>by me</p></header>a</article>", "Title a"),
    ("<nav><h1>x</h1></nav><main>m<form>f<input value='>'></form></main>", "m"),
    ("<div role='main'>r</div>", "r"), ("<article>1 < 2 & 3<a title='a > b'>link</a></article>", "1 < 2 & 3link"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article>a<span hidden>h</span><span style='display: none'>x</span>b</article>", "a b"),
    ("<article>a</article><p>out</p><article>b</article>", "a b"), ("<article>a<b unclosed='", "a"),
    ("<article> \n a \t b \r\n</article>", "a b"), ("<article>a<script>never closed", "a"),
])
def test_markup(source, want):
    assert text(source) == want


def test_odd_markup_is_read_in_linear_time():
    for piece in ("<", "<a \"", "<p>", "<div>", "<!--", "<script>", "&", "<li>", "</p>", "<b><p>"):
        h.read_page("<article>" + piece * 20_000)


def test_suffix_groups_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        streams = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(0, 6))]
        hosts = [rng.choice("xy") for _ in streams]
        for run in (1, 2, 3, 6, 8):
            got, want = {}, {}
            for p, i, g in zip(*(a.tolist() for a in h.suffix_groups(streams, hosts, run))):
                got.setdefault(g, []).append((p, i))
            for p, s in enumerate(streams):
                for i in range(len(s) - run + 1):
                    want.setdefault((hosts[p], tuple(s[i:i + run])), []).append((p, i))
            assert sorted(map(sorted, got.values())) == sorted(want.values())


def pages(spark):
    menu, foot = "Home News Sport Weather Travel Money Shop", "All rights reserved by the owners of this site"
    rows = [(i, f"http://a.example/{i}", f"<p>{menu}</p><p>Story {i} has words {i} of its own {i} here</p><p>{foot}</p>")
            for i in range(6)]
    rows += [(6, "http://b.example/", f"<p>{menu}</p><p>Only page of its host</p>"),
             (7, "http://c.example/1", "<p>the very same page is copied as a whole</p>"),
             (8, "http://c.example/2", "<p>the very same page is copied as a whole</p>"),
             (9, None, None), (10, "no scheme", ""), (None, "http://a.example/x", "<article>one</article>" + f"<p>{menu}</p>"),
             (11, "http://a.example/y", "<article>" + "long " * 50_000 + "</article>"), (11, "http://a.example/y", "<article>twice</article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("row", "host", "id", "text", "a", "b", "p", "article", "starts", "t"):
        frame = frame.withColumn(c, F.lit("clash"))
    return frame.repartition(4)


def test_repeated_substrings_of_a_host_go(spark):
    got = {(r.page_id, r.n_chars): r for r in h.extract(pages(spark)).collect()}
    for i in range(6):
        want = f"Story {i} has words {i} of its own {i} here"
        assert got[(i, len(want))].text == want
    by_id = {k[0]: r for k, r in got.items()}
    assert by_id[6].text == "Home News Sport Weather Travel Money Shop Only page of its host"
    assert by_id[7].text == by_id[8].text == "the very same page is copied as a whole"
    assert by_id[9].text == by_id[10].text == "" and by_id[9].n_chars == 0
    assert by_id[None].text == "one"
    assert (11, 249_999) in got and (11, 5) in got
    assert len(got) == 14
    # many small arrays merge to the same substrings
    again = {(r.page_id, r.n_chars): r for r in h.extract(pages(spark).coalesce(1), chunk_tokens=1).collect()}
    assert again == got


def test_empty_table(spark):
    assert h.extract(pages(spark).limit(0)).count() == 0


def extracted(spark, rows, **kw):
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(rows)],
                                  "page_id long, url string, html string")
    return [r.text for r in sorted(h.extract(frame.repartition(3), **kw).collect(), key=lambda r: r.page_id)]


LICENCE = "This text may be shared under the licence named on the first page of our site"


def story(i):
    return " ".join(f"word{i}x{k}" for k in range(30))


def test_articles_keep_what_they_share(spark):
    rows = [("a.example", f"<article><h1>Daily</h1><p>{story(i)}</p><p>{LICENCE}</p></article>") for i in range(5)]
    assert extracted(spark, rows) == [f"Daily {story(i)} {LICENCE}" for i in range(5)]
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(rows)],
                                  "page_id long, url string, html string")
    n = len(LICENCE.split()) - h.RUN + 1
    assert [r.n_repeated for r in h.extract(frame).collect()] == [n] * 5


def test_near_copies_that_differ_in_long_blocks_lose_nothing(spark):
    common = [story(50 + k) for k in range(4)]
    bodies = [common + [f"{story(200 + 3 * i + k)} own" for k in range(3)] for i in range(3)]
    rows = [("a.example", f"<nav>{MENU}</nav><article>" + "".join(f"<p>{b}</p>" for b in body) + "</article>") for body in bodies]
    assert extracted(spark, rows) == [" ".join(body) for body in bodies]


def test_repeated_substrings_decide_outside_articles(spark):
    rows = [("a.example", f"<p>{story(i)}</p><p>{LICENCE}</p>") for i in range(5)]
    rows += [("b.example", f"<p>{story(0)}</p><p>{LICENCE}</p>")] * 2      # whole copies
    want = [story(i) for i in range(5)] + [f"{story(0)} {LICENCE}"] * 2
    assert extracted(spark, rows) == want
    assert extracted(spark, rows, chunk_tokens=1) == want
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(rows)],
                                  "page_id long, url string, html string")
    n = len(LICENCE.split()) - h.RUN + 1
    assert [r.n_repeated for r in h.extract(frame).orderBy("page_id").collect()] == [n] * 5 + [0, 0]


def brute_extract(rows, run=h.RUN):
    """{page number: (text, repeated substrings)} by comparing the substrings of all pages of a host; no copies among them."""
    seen, read = {}, []
    for i, (host, source) in enumerate(rows):
        page = h.read_page(source or "")
        wanted, left = h._candidates(page)
        blocks = [b for b, _, _ in page.blocks]
        tokens, mask = h._tokens(blocks), h._mask(blocks, wanted)
        read.append((host, blocks, wanted, left, tokens, mask))
        for k in range(len(tokens) - run + 1):
            seen.setdefault((host, tuple(tokens[k:k + run])), set()).add(i)
    out = {}
    for i, (host, blocks, wanted, left, tokens, mask) in enumerate(read):
        cover, held = [False] * len(tokens), set()
        for k in range(len(tokens) - run + 1):
            some = tuple(tokens[k:k + run])
            if len(seen[host, some]) > 1 and any(mask[k:k + run]):
                held.add(some)
                cover[k:k + run] = [True] * run
        stay, at = [], 0
        for block, w in zip(blocks, wanted):
            n = block.count(" ") + 1
            stay.append(w and (not left or sum(cover[at:at + n]) / n < h.COVERED))
            at += n
        stay = stay if any(stay) else wanted
        out[i] = (" ".join(b for b, s in zip(blocks, stay) if s), len(held))
    return out


def test_whole_result_against_brute_force(spark):
    rng = random.Random(8)
    phrases = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(4, 14))) for _ in range(25)]

    def page():
        blocks = [f"<{t}>{rng.choice(phrases) if rng.random() < 0.7 else ' '.join(f'u{rng.random()}' for _ in range(12))}</{t}>"
                  for t in rng.choices(["p", "div", "nav", "li"], k=rng.randint(1, 6))]
        own = f"<p>{' '.join(f'u{rng.random()}' for _ in range(90))}</p>"        # so that no page is a copy
        body = "".join([*blocks, own])
        return f"<article>{body}</article><p>{rng.choice(phrases)}</p>" if rng.random() < 0.4 else body

    rows = [(rng.choice(["a.example", "b.example"]), page()) for _ in range(60)]
    keys = [(k, host) for host, source in rows for k in h._copy_keys(texts_of(source), 1)]
    assert len(keys) == len(set(keys))
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", source) for i, (host, source) in enumerate(rows)],
                                  "page_id long, url string, html string").repartition(4)
    want = brute_extract(rows)
    assert {r.page_id: (r.text, r.n_repeated) for r in h.extract(frame, chunk_tokens=200).collect()} == want
    assert sum(n > 0 for _, n in want.values()) > 40


def texts_of(source):
    page = h.read_page(source)
    return [t for (t, _, _), w in zip(page.blocks, h._candidates(page)[0]) if w]


def test_every_article_of_the_given_pages_is_whole(spark):
    from credit_signals.llm.queries import op7_html_extraction
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: text(r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in op7_html_extraction(spark, sf).collect()}
    assert got.keys() == want.keys() and all(got[i] == t for i, t in want.items() if t)


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "site-main no-sidebar", "post comments-open", "article-header",
                                  "search-results", "with-banner", "nav-open"])
def test_layout_classes_are_no_chrome(name):
    assert text(f"<div class='{name}'><article>a<p>b</article></div>") == "a b"
    assert text(f"<article class='{name}'>a<p>b</article>") == "a b"
    assert [b for b in h.read_page(f"<div id='{name}'>a</div>").blocks] == [("a", False, False)]


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "ad-300x250", "share-buttons", "comments-area", "cookie-bar", "x nav"])
def test_chrome_classes(name):
    assert text(f"<article>a<div class='{name}'>gone</div>b</article>") == "a b"


def test_articles_are_no_chrome_by_class(spark):
    assert text("<div class=sidebar><div class=widget><article class=post>a</article></div></div>") == "a"
    assert text("<div class=header>menu<main class=search>a</main></div><article>b</article>") == "a b"
    assert text("<main>a</main><div class=comments><article class=comment>b</article></div>") == "a"
    assert text("<aside><article>a</article></aside>") == ""
    long = "the longest block of a page that is all chrome"
    assert extracted(spark, [("a.example", f"<nav>Home</nav><div class=popup>{long}</div>")]) == [long]


MENU, FOOT = "Home News Sport Weather Travel Money Shop", "All rights reserved by the owners of this site"


def test_near_copies_keep_their_body(spark):
    def page(*blocks):
        return "".join(f"<p>{b}</p>" for b in (MENU, *blocks, FOOT))

    body = [f"{story(90 + k)} end" for k in range(4)]
    edited = [*body[:3], body[3].replace("word93x5", "other")]
    bodies = [body + ["Monday the first of May"], body + ["Tuesday the second of May"], body, body,     # date, whole copies
              body + ["Seen 12 times", "by Ann"], edited, edited + ["Seen 9 times by our good and loyal readers"]]
    others = [("a.example", page(story(i))) for i in range(4)]
    copies = [("a.example", page(*b)) for b in bodies]
    assert extracted(spark, others + copies) == [story(i) for i in range(4)] + [" ".join(b) for b in bodies]
    # a large group of copies, each with its own counter, on a host of its own keeps all
    many = [("b.example", page(*body, f"counter {i}")) for i in range(40)]
    assert extracted(spark, many) == [" ".join((MENU, *body, f"counter {i}", FOOT)) for i in range(40)]
    assert extracted(spark, many + [("b.example", page(story(1)))])[0] == " ".join((*body, "counter 0"))


NOTICE = "Write to us if you want to read more of our stories"


def test_common_substrings_decide_inside_articles(spark):
    def page(i, *blocks):
        return f"<nav>{MENU}</nav><article><h1>Title {i}</h1><p>{story(i)}</p>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"

    # a notice without a class on twelve of fourteen pages goes, a sentence that some articles share stays
    rows = [("a.example", page(i, LICENCE if i % 3 == 0 else story(70 + i), *[NOTICE] * (i < 12))) for i in range(14)]
    want = [f"Title {i} {story(i)} {LICENCE if i % 3 == 0 else story(70 + i)}" for i in range(14)]
    assert extracted(spark, rows) == want
    assert extracted(spark, rows, chunk_tokens=1) == want
    # not on a host where most pages lack it, on few pages, among copies, or where it is most of the article
    others = [("b.example", page(200 + i, *[NOTICE] * (i < 12))) for i in range(25)]
    others += [("c.example", page(300 + i, NOTICE)) for i in range(9)]
    others += [("d.example", page(400, NOTICE))] * 30
    others += [("a.example", f"<article><p>Title of this</p><p>{NOTICE}</p></article>")]
    assert extracted(spark, rows + others) == want + [" ".join(h._tokens([t for t, a, c in h.read_page(p).blocks if a and not c]))
                                                      for _, p in others]
