import hashlib
import random
import re
from collections import Counter

import pytest
from edge import SCHEMA, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from credit_signals.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet="ab.@+- ()0123456789%é", max_size=60), st.text(alphabet="0123456789. -+", max_size=60)))
def test_plain_spans_against_brute_force(text):
    assert pii.detect(text) == brute(text)


def test_cards():
    rng = random.Random(1)
    for _ in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(13, 20)))
        assert pii.luhn(digits) == luhn(digits)


@pytest.mark.parametrize("text, want", [
    ("write john.doe (at) mail (dot) com now", [("email", "john.doe (at) mail (dot) com")]),
    ("john dot doe at mail dot example dot com!", [("email", "john dot doe at mail dot example dot com")]),
    ("usеr@exаmple.com", [("email", "usеr@exаmple.com")]), ("user@mail dot com", [("email", "user@mail dot com")]),
    ("u​ser@mail.com", [("email", "u​ser@mail.com")]),
    ("plus one two one two five five five zero one two three", [("phone", "plus one two one two five five five zero one two three")]),
    ("pay four one one one 1111 1111 1111.", [("card", "four one one one 1111 1111 1111")]),
    ("at １９２.１６８.1.1 now", [("ip", "１９２.１６８.1.1")]), ("ip 10 dot 0 dot 0 dot 7", [("ip", "10 dot 0 dot 0 dot 7")]),
    ("meet me at the station on platform one or two", []), ("a dot on the map at noon", []), ("John@home, see you", []),
    ("été à Montréal, 50 % ou 3–4 fois", []), ("", []),
])
def test_disguises(text, want):
    base, added = pii.find(text)
    assert [(pii.KINDS[k], text[a:z]) for a, k, z in added] == want
    assert base == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab@. one two plus dot at()＠１а​", max_size=50))
def test_normalised_characters_point_into_the_source(text):
    mapped = pii.normalise(text)
    if mapped:
        assert len(mapped.text) == len(mapped.start) == len(mapped.end)
        assert all(0 <= a < z <= len(text) for a, z in zip(mapped.start, mapped.end))
        assert mapped.start == sorted(mapped.start)
    base, added = pii.find(text)
    assert base == brute(text)


def test_long_texts_are_read_in_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "one " * 40_000, "1." * 100_000, "a dot " * 30_000, " at a" + " dot a" * 20_000,
                 " " * 200_000 + " dot ", "(" * 100_000 + " dot", "+1 " * 50_000):
        pii.find(text)


def test_rows(spark):
    extra = [(30, "mail a.b@c.org and 10.0.0.1, +1 (212) 555-0153 or 4111 1111 1111 1111"), (31, "x" * 70_000 + " a@b.co")]
    docs = documents(spark, [(i, t) for i, t in documents(spark).select("doc_id", "text").collect()] + extra)
    want = Counter()
    for r in docs.collect():
        text = r.text or ""
        base, added = pii.find(text)
        assert base == brute(text)
        join = lambda s: ",".join(f"{pii.KINDS[k]}:{a}:{z}" for a, k, z in s)
        want[(r.doc_id, *(sum(k == n for _, k, _ in base) for n in range(4)),
              hashlib.sha256(join(base).encode()).hexdigest(), join(sorted(base + added)), len(added))] += 1
    assert Counter(tuple(r) for r in pii.spans(docs).collect()) == want
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[30] == "mail <email> and <ip>, <phone> or <card>" and clean[5] is None
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.spans(empty).count() == 0 and pii.redact(empty).columns == empty.columns


@pytest.mark.parametrize("text, kind, want", [
    ("anna at firma dot cz", "email", None), ("anna at firma dot kr", "email", None), ("anna at firma dot online", "email", None),
    ("anna at firma dot xyz", "email", None), ("write ann_at_mail_dot_com now", "email", "ann_at_mail_dot_com"),
    ("ann-lee-at-my-host-dot-co-dot-uk", "email", None), ("ann_dot_lee_at_mail_dot_com", "email", None),
    ("4 one 1 one 1111 1111 1111", "card", None), ("4111 one111 1111", "card", ""), ("411 one 1111 1111 1111", "card", None),
    ("+1 two 12 five 55 zero 153", "phone", None), ("plus 1 212 555 zero 153", "phone", None),
    ("call +1 212 555 0153, one of us", "phone", ""), ("look_at_me dot dot", "email", ""), ("12 one 3", "card", ""),
])
def test_common_disguises(text, kind, want):
    want = [(kind, text if want is None else want)] if want != "" else []
    assert [(pii.KINDS[k], text[a:z]) for a, k, z in pii.find(text)[1]] == want


def test_joined_and_mixed_long_texts_are_read_in_linear_time():
    for text in ("a_dot_" * 40_000, "a-at-b-dot-" * 20_000, "1 one " * 40_000, "1" * 200_000 + " one", "1 " * 100_000 + "one"):
        pii.find(text)


@pytest.mark.parametrize("text", [
    "we met at home dot it was late", "look at the dot on the map", "see me at noon dot is that right", "look at that dot so nice",
    "point at A dot in the plane", "look at the dot one day", "stay at work dot no more", "arrive at five dot we wait", "one dot two dot three",
    "she looked at him dot he smiled", "at rest dot me too"])
def test_prose_has_no_addresses(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("text, kind, span", [
    ("say joe @ mail dot com now", 0, "joe @ mail dot com"), ("ten dot one dot two dot three", 1, "ten dot one dot two dot three"),
    ("at one nine two dot one six eight dot one dot one, ok", 1, "one nine two dot one six eight dot one dot one"),
    ("write to ann at host dot it", 0, "ann at host dot it"), ("ann_b at host dot it", 0, "ann_b at host dot it"),
    ("ann [at] host [dot] it", 0, "ann [at] host [dot] it"), ("anna at firma dot cz", 0, "anna at firma dot cz"),
    ("twenty five dot 1 dot two dot three", 1, "twenty five dot 1 dot two dot three")])
def test_spelled_identifiers(text, kind, span):
    start = text.index(span)
    assert pii.find(text) == ([], [(start, kind, start + len(span))])


def disguised(rng):
    """(kind, text) of an identifier in a disguise that the operator promises to read."""
    pick = rng.choice
    words = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
    if pick([True, False]):
        name, host, end = pick(["anna", "j_doe", "max7"]), pick(["firma", "posteo", "web-mail"]), pick(["com", "net", "cz", "info"])
        at, dot = pick([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", " dot "), ("{at}", "{.}")])
        if pick([True, False]):
            name = name.replace("a", "а")        # Cyrillic
        return 0, f"{name}{at}{host}{dot}{end}"
    parts = [str(rng.randint(0, 255)) for _ in range(4)]
    spelled = rng.randrange(4)
    return 1, " dot ".join(" ".join(words[int(d)] for d in p) if i == spelled or rng.random() < 0.4 else p
                           for i, p in enumerate(parts))


def test_disguises_against_their_construction():
    rng = random.Random(9)
    prose = ["we sat by the river,", "nothing to see here;", "the meeting was long.", "look at the sky!", "Schöne Grüße;"]
    for _ in range(500):
        text, want = rng.choice(prose), []
        for _ in range(rng.randint(1, 3)):
            kind, some = disguised(rng)
            start = len(text) + 1
            text = f"{text} {some}, {rng.choice(prose)}"
            want.append((start, kind, start + len(some)))
        base, added = pii.find(text)
        assert (base, added) == ([], want), text
