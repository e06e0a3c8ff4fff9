"""Main text of web pages by markup and host suffix arrays.

1. Each page is read into blocks of text.  Markup proposes: menus, headers, footers, sidebars, notices, adverts, forms, comments,
   scripts and styles are chrome; the blocks inside an article (or main) element,
   or all others on a page without one, are candidates.
2. All blocks of a page are a token stream.  A task concatenates the streams of
   its pages and sorts all suffixes by their first ``run`` tokens (prefix
   doubling on ranks: a suffix array, cut at that depth).  Neighbours that agree
   are one substring.  The tasks' arrays are merged by a key of host and leading
   tokens, which tells on which pages a substring stands.
3. Pages of a host with the same candidates, or that differ in one block or in
   short ones, are copies and count as one.  What stands on pages that are no
   copies of each other is repeated across the host, and every page is told how
   many such substrings its candidates hold.
4. The substrings decide on every page which candidates go.  On pages without an
   article, where markup leaves the blocks open, those that repeated substrings
   cover go, unless nothing would be left.  Sentences that some articles share are
   still their text, so a block of an article goes only if substrings that stand
   on most pages of the host cover all of it, as notices without a class do, and
   if most of the article is left.

A task's array is bounded by ``chunk_tokens`` and one page, the merge is cut into
ranges of keys by the number of tokens, and no host is gathered in one task.
Arrays travel as sorted keys, coded by their differences; a key has as many bits
as make chance meetings equally rare at every size of the input.
"""

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, ship
from .components import components
from .url_filter import url_host

CHUNK_TOKENS = 1 << 20
RUN = 6                          # tokens that two pages must share
COVERED = 0.6                    # share of a block's tokens in repeated substrings that makes it boilerplate
COPIED = 0.75                    # share of a page's tokens in common blocks that makes it a copy
LONG = 8                         # tokens of a block that is no date, byline or counter
COMMON_PAGES = 10                # pages of a host, no copies of each other, that a notice inside articles stands on at least
COMMON = 0.5                     # and the share of the host's pages that have it, and of an article that may be notices
SPARE_BITS = 14                  # of a key beyond the number of substrings: one in 2^14 meets another by chance
CHARS_PER_TOKEN = 6
BUCKET_TOKENS = 1 << 22          # tokens of one range of the merge

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(>|\Z)?)""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""")
_NAME_PARTS = re.compile(r"(?:[-_]|[0-9]+(?:x[0-9]+)?)+")
_MAIN_ROLE = re.compile(r"""\brole\s*=\s*["']?(?:main|article)\b""", re.I)

RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = frozenset("nav header footer aside form button select menu dialog svg canvas audio video object label "
                        "fieldset datalist head map math".split())
CHROME_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adsense advert adverts advertisement sponsor "
    "sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe signup login share sharing social related recommended recommendations comment comments disqus replies "
    "reply respond breadcrumb breadcrumbs pagination pager widget widgets toolbar skip search".split())
# what may stand beside such a name in one class or id: "site-footer", "share-buttons", but not "has-sidebar", "article-header"
CHROME_BESIDE = frozenset("site main top bottom primary secondary global area list links buttons bar box item items container "
                          "form icons posts".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                         "toolbar".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary "
                   "table tbody td tfoot th thead tr ul caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an opening tag ends an open element of these names, up to the nearest of the others
_ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
         "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select", "datalist"))}
_P_STAYS = BLOCKS - {"p", "br"}


@dataclass
class Page:
    """Blocks in page order: text, inside an article, chrome by markup."""

    blocks: list[tuple[str, bool, bool]] = field(default_factory=list)


def _chrome_name(value: str) -> bool:
    """Whether a class or id value has a token of chrome names only, but for neutral parts."""
    for token in value.split():
        parts = [x for x in _NAME_PARTS.split(token) if x]
        if any(x in CHROME_NAMES for x in parts) and all(x in CHROME_NAMES or x in CHROME_BESIDE for x in parts):
            return True
    return False


def _chrome(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is chrome by its tag, role or style, and whether it is by class or id."""
    if name in CHROME_TAGS:
        return True, False
    if not attributes or name in ("html", "body"):
        return False, False
    named = False
    for m in _ATTR.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        named = named or key in ("class", "id") and _chrome_name(value)
        if key == "role" and value in CHROME_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, named
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True, named
    return False, named


def read_page(source: str) -> Page:
    """The blocks of a page; white space inside a block is one space, character references are decoded.

    A main element and what contains it is no chrome by its class, and neither
    are articles if the page has no other text in an article.
    """
    page, mains, articles = _read(source, frozenset())
    if mains:
        page, _, articles = _read(source, frozenset(mains))
    if articles and not any(article and not chrome for _, article, chrome in page.blocks):
        page = _read(source, frozenset(mains + articles))[0]
    return page


def _read(source: str, spared: frozenset[int]) -> tuple[Page, list[int], list[int]]:
    """The page, and where the elements start that are chrome by class and are or contain a main element, an article."""
    page, at, text = Page(), 0, []
    stack: list[tuple[str, bool, bool]] = []     # open elements: name, inside an article, chrome
    named: list[int] = []                        # where the open elements start that are chrome by class
    starts: list[int] = []
    mains: dict[int, None] = {}
    articles: dict[int, None] = {}

    def flush() -> None:
        words = "".join(text).split()
        text.clear()
        if words:
            _, article, chrome = stack[-1] if stack else ("", False, False)
            page.blocks.append((" ".join(words), article, chrome))

    def close(names, until=()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                outer = stack[i - 1][1:] if i else (False, False)
                if stack[-1][1:] != outer or any(e[0] in BLOCKS for e in stack[i:]):
                    flush()                      # an inline end tag inside a block leaves the block open
                del stack[i:]
                while named and named[-1] >= starts[i]:
                    named.pop()
                del starts[i:]
                return
            if stack[i][0] in until:
                return

    for m in iter(lambda: _TAG.search(source, at), None):
        if m.start() > at:
            text.append(html.unescape(source[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[4] != ">":                          # the page ends inside a tag
            at = len(source)
            break
        if m[1]:
            if name in BLOCKS:
                flush()
            close((name,))
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name in BLOCKS:
            flush()
            if name != "br":
                close(("p",), _P_STAYS)
        if name in _ENDS:
            close(*_ENDS[name])
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        _, article, chrome = stack[-1] if stack else ("", False, False)
        by_markup, by_class = _chrome(name, m[3])
        by_class = by_class and m.start() not in spared
        chrome = (chrome or by_markup or by_class) and not (article and name in HEADINGS and _only_header(stack))
        role = _MAIN_ROLE.search(m[3]) if "role" in m[3] else None
        opens = name in ("article", "main") or role is not None
        if opens and chrome and not article:     # an article inside another (a comment) has its class count
            found = mains if name == "main" or role and role[0].lower().endswith("main") else articles
            if by_class:
                found[m.start()] = None
            for c in reversed(named):            # those further out are known already
                if c in found:
                    break
                found[c] = None
        article = article or opens
        if name in BLOCKS or chrome != (stack[-1][2] if stack else False):
            flush()
        stack.append((name, article, chrome))
        starts.append(m.start())
        if by_class:
            named.append(m.start())
    if at < len(source):
        text.append(html.unescape(source[at:]))
    flush()
    return page, list(mains), list(articles)


def _only_header(stack: list[tuple[str, bool, bool]]) -> bool:
    """Whether the nearest chrome around is a header element of the article: its headings are the article's title."""
    chrome = [name for name, article, is_chrome in stack if is_chrome and article]
    outside = any(is_chrome and not article for _, article, is_chrome in stack)
    return bool(chrome) and chrome[0] == "header" and not outside and set(chrome) <= {"header", "div", "hgroup"}


def numbered(flat: list[str]) -> tuple[np.ndarray, list[str]]:
    """(number of each token, the distinct tokens in order of their numbers)."""
    number = dict(zip(dict.fromkeys(flat), range(len(flat))))
    return np.fromiter(map(number.__getitem__, flat), np.int64, len(flat)), list(number)


def suffix_groups(streams: list[list[str]], hosts: list[str], run: int, ids: np.ndarray | None = None
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, position, group) of every suffix with ``run`` tokens or more; equal groups share host and leading tokens.

    Prefix doubling: ranks of two halves are joined until they cover ``run``
    tokens.  ``ids`` are the numbers of all tokens in a row, if known.
    """
    sizes = np.fromiter(map(len, streams), np.int64, len(streams))
    ids = numbered([t for s in streams for t in s])[0] if ids is None else ids
    tokens = int(ids.max(initial=-1)) + 1
    page = np.repeat(np.arange(len(streams)), sizes)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    position = np.arange(ids.size) - start
    left = np.repeat(sizes, sizes) - position    # tokens up to the end of the page
    known: dict[str, int] = {}
    host = np.fromiter((known.setdefault(h, len(known)) for h in hosts), np.int64, len(hosts))
    rank = np.repeat(host, sizes) * tokens + ids
    if rank.max(initial=0) >= 1 << 31:           # two ranks must fit a word
        rank = np.unique(rank, return_inverse=True)[1]
    whole, depth = np.flatnonzero(left >= run), 1
    while depth < run:
        step = min(depth, run - depth)           # the second half may overlap the first
        follows = np.full(rank.size, -1, np.int64)
        has = left > step
        follows[has] = rank[np.flatnonzero(has) + step]
        rank = rank * (rank.max(initial=0) + 2) + follows + 1
        depth += step
        if depth < run:
            rank = np.unique(rank, return_inverse=True)[1]
    order = whole[np.argsort(rank[whole], kind="stable")]        # the suffix array, cut at ``run`` tokens
    return page[order], position[order], rank[order]


_SPREAD = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_SUBSTRING, _WANTED, _PAGE, _COPY, _OPEN, _HOST = range(6)     # kinds of rows; a wanted substring touches a candidate block


def _candidates(page: Page) -> tuple[list[bool], bool]:
    """Which blocks markup proposes as text, and whether it leaves them open.

    Those inside an article, of which only notices go, or all but chrome, or the longest if all are chrome.
    """
    inside = [article and not chrome for _, article, chrome in page.blocks]
    if any(inside):
        return inside, False
    plain = [not chrome for _, _, chrome in page.blocks]
    if any(plain) or not plain:
        return plain, True
    longest = max(range(len(plain)), key=lambda i: len(page.blocks[i][0]))
    return [i == longest for i in range(len(plain))], True


def _proposed(source: str | None) -> tuple[list[str], list[bool], bool]:
    """(blocks, which are candidates, whether they are left open) of a page."""
    page = read_page(source or "")
    return [t for t, _, _ in page.blocks], *_candidates(page)


def _mask(blocks: list[str], wanted: list[bool]) -> np.ndarray:
    """Whether each token of the page's stream is in a candidate block."""
    sizes = [text.count(" ") + 1 for text in blocks]
    return np.repeat(np.array(wanted, bool), sizes) if sizes else np.zeros(0, bool)


def _tokens(blocks: list[str]) -> list[str]:
    return " ".join(blocks).split(" ") if blocks else []


def _keys(ids: np.ndarray, names: list[str], host: np.ndarray, run: int, bits: int) -> np.ndarray:
    """Keys of the substrings that start at each token (of ``host``'s digest there) and have ``run`` tokens."""
    digests = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in names), np.uint64, len(names))
    words = digests[ids]
    n = max(0, words.size - run + 1)
    key = np.zeros(n, np.uint64)
    for j in range(run):
        key = key * np.uint64(_SPREAD) + words[j:j + n]
    key ^= host[:n]
    for shift, by in zip((30, 27), _MIX):
        key = (key ^ (key >> np.uint64(shift))) * np.uint64(by)
    return (key ^ (key >> np.uint64(31))) >> np.uint64(64 - bits)


def _host_digest(host: str | None) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest((host or "").encode("utf-8", "surrogatepass"), 1))


def _copy_keys(texts: list[str], host: np.uint64) -> list[int]:
    """Keys of which copies on one host share one: digests of sets of candidate texts with ``COPIED`` of the tokens.

    The sets are all blocks, all but one, the long ones, all but one of these, and the longest few.  So pages meet
    that differ in one block, in any number of short ones, or in one and some short ones.
    """
    blocks = sorted(((t.count(" ") + 1, xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), int(host))) for t in texts),
                    reverse=True)
    least, keys = COPIED * sum(n for n, _ in blocks), set()
    for some in (blocks, [b for b in blocks if b[0] >= LONG]):
        size, digest = sum(n for n, _ in some), sum(d for _, d in some)
        keys.update(digest - d for n, d in [(0, 0), *some] if size - n >= least)
    size = digest = 0
    for n, d in blocks:
        size, digest = size + n, digest + d
        if size >= least:
            keys.add(digest)
    return sorted({k % (1 << 64) for k in keys}) if blocks else []


def _packed(keys: np.ndarray, pages: np.ndarray, bits: int) -> bytes:
    """Sorted keys, as the byte planes of their differences, with the number of a page (and a flag) each."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(3).compress(
        planes[:bits // 8 + 1].tobytes() + pages.astype(np.uint16).view(np.uint8).reshape(-1, 2).T.tobytes())


def _unpacked(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    width = min(8, bits // 8 + 1)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width + 2, -1)
    keys = np.zeros((planes.shape[1], 8), np.uint8)
    keys[:, :width] = planes[:width].T
    return np.cumsum(keys.view(np.uint64).ravel(), dtype=np.uint64), \
        np.ascontiguousarray(planes[width:].T).view(np.uint16).ravel()


def _local_arrays(run: int, chunk_tokens: int, buckets: int, bits: int):
    """A task's suffix arrays: (bucket, kind, base, data): the keys of a bucket, page ids, copy keys, hosts."""
    def build(base: int, pages: list[int], hosts: list[str], streams: list[list[str]], masks: list[np.ndarray],
              copies: list[tuple[int, int]], undecided: list[tuple[int, int]]) -> pa.RecordBatch:
        ids, names = numbered([t for s in streams for t in s])
        page, position, group = suffix_groups(streams, hosts, run, ids)
        sizes = np.fromiter(map(len, streams), np.int64, len(streams))
        starts = np.cumsum(sizes) - sizes
        spot = starts[page] + position
        digests = np.array([_host_digest(h) for h in hosts], np.uint64)
        key = _keys(ids, names, np.repeat(digests, sizes), run, bits)[spot]
        inside = np.concatenate(([0], np.cumsum(np.concatenate(masks))))
        wanted = inside[spot + run] > inside[spot]
        pairs = [(_PAGE, np.array(list(enumerate(pages)), np.int64)), (_COPY, np.array(copies, np.uint64)),
                 (_OPEN, np.array(undecided, np.int64)),
                 (_HOST, np.column_stack((np.arange(digests.size, dtype=np.uint64), digests)))]
        spread = ((base >> 35) + (base >> 15 & 0xFFFFF)) % buckets               # by task and chunk
        rows = [(spread, kind, base, pair.tobytes()) for kind, pair in pairs if pair.size]
        if group.size:                           # one entry per substring and page: neighbours in the array
            cuts = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (page[1:] != page[:-1]))))
            key, page, wanted = key[cuts], page[cuts], np.maximum.reduceat(wanted, cuts)
            order = np.argsort(key, kind="stable")
            key, tag = key[order], page[order] * 2 + wanted[order]
            bucket = (key >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
            edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            rows += [(b, _SUBSTRING, base, _packed(key[a:z], tag[a:z], bits)) for b, (a, z) in enumerate(zip(edges, edges[1:])) if a < z]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int8(), pa.int64(), pa.binary()))],
                                          names=["bucket", "kind", "base", "data"])

    def run_task(batches):
        chunk, size = TaskContext.get().partitionId() << 20, 0
        pages, hosts, streams, masks, copies, undecided = held = [], [], [], [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for page, host, source in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    blocks, wanted, open_ = _proposed(source)
                    texts = [t for t, w in zip(blocks, wanted) if w]
                    copies += [(len(pages), k) for k in _copy_keys(texts, _host_digest(host))]
                    undecided += [(len(pages), 0)] if open_ else []
                    pages.append(page), hosts.append(host), streams.append(_tokens(blocks)), masks.append(_mask(blocks, wanted))
                    size += len(streams[-1])
                    if size >= chunk_tokens or len(pages) == 1 << 15:
                        yield build(chunk << 15, *held)
                        chunk, size = chunk + 1, 0
                        for each in held:
                            each.clear()
        if pages:
            yield build(chunk << 15, *held)

    return run_task


def _merge(bits: int):
    return lambda key, table: _merged(key, table, bits)


def _merged(key, table, bits: int):
    """(number, key, kind, often) of one bucket: the pages of substrings that stand on two, page ids, copy keys, hosts.

    ``often`` marks candidates' substrings that stand on ``COMMON_PAGES`` pages, copies included.
    """
    kind, bases, data = key[1].as_py(), table.column("base").to_pylist(), table.column("data").to_pylist()
    if kind == _SUBSTRING:
        parts = [_unpacked(d, bits) for d in data]
        keys = np.concatenate([k for k, _ in parts])
        tags = np.concatenate([t for _, t in parts])
        numbers = np.repeat(np.array(bases, np.int64), [t.size for _, t in parts]) + (tags >> 1)
        order = np.argsort(keys, kind="stable")  # a merge of sorted runs
        keys, numbers, tags = keys[order], numbers[order], tags[order]
        same = keys[1:] == keys[:-1]
        many = np.append(same, False) | np.concatenate(([False], same))[:keys.size]
        keys, numbers, kinds = keys[many].view(np.int64), numbers[many], (tags[many] & 1).astype(np.int8)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if keys.size else np.zeros(0, np.int64)
        pages = np.diff(first, append=keys.size)
        often = np.repeat((pages >= COMMON_PAGES) & (np.maximum.reduceat(kinds, first) > 0), pages) if keys.size else np.zeros(0, bool)
    else:
        parts = [np.frombuffer(d, np.int64).reshape(-1, 2) for d in data]
        numbers = np.concatenate([p[:, 0] + base for p, base in zip(parts, bases)])
        keys, kinds, often = np.concatenate([p[:, 1] for p in parts]), np.full(numbers.size, kind, np.int8), np.zeros(numbers.size, bool)
    return pa.table({"number": pa.array(numbers, pa.int64()), "key": pa.array(keys, pa.int64()), "kind": pa.array(kinds, pa.int8()),
                     "often": pa.array(often, pa.bool_())})


def _copies(merged: DataFrame) -> DataFrame:
    """(number, first): pages that are copies of others on their host, with the least of their group."""
    keys = merged.where(F.col("kind") == _COPY).select("number", "key")
    least = keys.groupBy("key").agg(F.min("number").alias("u"), F.max("number").alias("last")).where("u <> last")
    links = keys.join(least.select("key", "u"), "key").select("u", F.col("number").alias("v"))
    return components(links).select(F.col("vertex").alias("number"), F.col("root").alias("first"))


def _common(merged: DataFrame, copies: DataFrame) -> DataFrame:
    """(key, common): substrings that stand on more than the share ``COMMON`` of a host's pages, and on ``COMMON_PAGES``."""
    first = F.coalesce("first", "number").alias("first")
    hosts = merged.where(F.col("kind") == _HOST).select("number", F.col("key").alias("host"))
    pages = hosts.join(copies, "number", "left").groupBy("host").agg(F.countDistinct(first).alias("pages"))
    held = merged.where("often").join(copies, "number", "left").groupBy("key") \
        .agg(F.countDistinct(first).alias("on"), F.min("number").alias("number")).where(F.col("on") >= COMMON_PAGES)
    return held.join(hosts, "number").join(pages, "host").where(F.col("on") > F.col("pages") * COMMON) \
        .select("key", F.lit(True).alias("common"))


def _repeated(merged: DataFrame) -> DataFrame:
    """(page, n, keys): how many repeated substrings a page's candidates hold; which, or of an article the common ones."""
    found = merged.where(F.col("kind") <= _WANTED)
    copies = _copies(merged)
    grouped = found.join(copies, "number", "left").select("key", F.coalesce("first", "number").alias("first"))
    across = grouped.groupBy("key").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low <> high")
    undecided = merged.where(F.col("kind") == _OPEN).select("number", F.lit(True).alias("open"))
    held = found.where(F.col("kind") == _WANTED).join(across.select("key"), "key", "left_semi") \
        .join(_common(merged, copies), "key", "left").join(undecided, "number", "left").groupBy("number") \
        .agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.coalesce("open", "common"), F.col("key"))).alias("keys"))
    pages = merged.where(F.col("kind") == _PAGE).select("number", F.col("key").alias("page"))
    # a page that is there more than once has equal substrings each time
    return held.join(pages, "number").groupBy("page").agg(F.max("n").alias("n"), F.max_by("keys", "number").alias("keys"))


def _cover(blocks: list[str], host: str | None, keys: list[int], run: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens that the substrings ``keys`` cover) of each block."""
    ids, names = numbered(_tokens(blocks))
    spots = np.flatnonzero(np.isin(_keys(ids, names, np.full(ids.size, _host_digest(host)), run, bits).view(np.int64), keys))
    mark = np.zeros(ids.size + 1, np.int64)
    mark[spots] += 1
    np.subtract.at(mark, spots + run, 1)
    edges = np.cumsum([0] + [t.count(" ") + 1 for t in blocks])
    return np.diff(edges), np.diff(np.append(0, np.cumsum(np.cumsum(mark)[:-1] > 0))[edges])


def _left(blocks: list[str], wanted: list[bool], host: str | None, keys: list[int], run: int, bits: int) -> list[bool]:
    """Which candidate blocks of an open page stay: those that repeated substrings do not cover."""
    size, covered = _cover(blocks, host, keys, run, bits)
    stay = (np.array(wanted) & (covered / size < COVERED)).tolist()
    return stay if any(stay) else wanted


def _told(blocks: list[str], host: str | None, keys: list[int], run: int, bits: int) -> list[str]:
    """The blocks of an article without those that common substrings cover whole, if these are the lesser part."""
    size, covered = _cover(blocks, host, keys, run, bits)
    notice = covered == size
    if size[notice].sum() >= COMMON * size.sum():
        return blocks
    return [t for t, gone in zip(blocks, notice.tolist()) if not gone]


_TEXT = T.StructType([T.StructField("data", T.BinaryType()), T.StructField("open", T.BooleanType())])


def _proposals(pages: pa.Array) -> pa.Array:
    """Compressed: the candidate blocks of a page with an article; all blocks of an open one, each behind its mark."""
    pack, data, opens = zstandard.ZstdCompressor(9).compress, [], []
    for at in range(0, len(pages), 64):
        for source in pages.slice(at, 64).to_pylist():
            blocks, wanted, open_ = _proposed(source)
            text = "\n".join("-+"[w] + t for t, w in zip(blocks, wanted)) if open_ else \
                "\n".join(t for t, w in zip(blocks, wanted) if w)
            data.append(pack(text.encode("utf-8", "replace")))
            opens.append(open_)
    return pa.StructArray.from_arrays([pa.array(data, pa.binary()), pa.array(opens, pa.bool_())], names=_TEXT.names)


def _texts(run: int, bits: int):
    """The text of each proposal, without the blocks that the substrings of its page cover."""
    def text_of(data: bytes, open_: bool, host: str | None, keys: list[int] | None) -> str:
        text = zstandard.ZstdDecompressor().decompress(data).decode()
        if not text:
            return text
        rows = text.split("\n")
        if not open_:
            return " ".join(_told(rows, host, keys, run, bits) if keys else rows)
        blocks, wanted = [r[1:] for r in rows], [r[0] == "+" for r in rows]
        stay = _left(blocks, wanted, host, keys, run, bits) if keys else wanted
        return " ".join(t for t, s in zip(blocks, stay) if s)

    def texts(*columns: pa.Array) -> pa.Array:
        return pa.array([text_of(*row) for at in range(0, len(columns[0]), 64)
                         for row in zip(*(c.slice(at, 64).to_pylist() for c in columns))], pa.string())

    return F.arrow_udf(texts, T.StringType())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            run: int = RUN, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per input row: id, url, text, n_chars, n_repeated.

    ``text`` is empty if a page has none; null html counts as empty, a null url
    has the empty host.  ``n_repeated`` counts the distinct substrings of ``run``
    tokens in its candidate blocks that stand on another page of the host that is
    no copy of this one.  A very long page is an array of its own.  Repeated rows
    get a row each and null ids stay null; an empty table gives an empty result;
    other columns of ``pages`` play no part.
    """
    ship(pages.sparkSession)
    url, source = F.col(url_col), F.col(html_col)
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), url_host(url).alias("host"), source.alias("html"),
                        F.xxhash64(url, source).alias("page"))
    tokens = (rows.agg(F.sum(F.length("html"))).first()[0] or 0) // CHARS_PER_TOKEN        # at most, about
    buckets, bits = 1 + tokens // BUCKET_TOKENS, min(63, max(32, tokens.bit_length() + SPARE_BITS))
    merged = materialise(
        rows.select("page", "host", "html")
        .mapInArrow(_local_arrays(run, chunk_tokens, buckets, bits), "bucket int, kind byte, base long, data binary")
        .groupBy("bucket", "kind").applyInArrow(_merge(bits), "number long, key long, kind byte, often boolean"), "substrings")
    repeated = materialise(_repeated(merged), "repeated")
    proposed = rows.select("id", "url", "page", F.arrow_udf(_proposals, _TEXT)("html").alias("t")).select("id", "url", "page", "t.*")
    text = _texts(run, bits)("data", "open", url_host(F.col("url")), "keys").alias("text")
    # one plan at every size: texts and counts meet by a merge join, also where the counts are few
    return proposed.join(repeated.hint("merge"), "page", "left").select("id", "url", text, F.coalesce("n", F.lit(0)).alias("n_repeated")) \
        .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                F.char_length("text").cast("long").alias("n_chars"), "n_repeated")
