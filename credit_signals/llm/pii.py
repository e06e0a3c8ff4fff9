"""Personal data with offset-preserving deobfuscation.

The plain detectors run on the text as it is.  Then transducers rewrite
disguises (look-alike characters, spelled digits, at/dot spellings) into a
normalised text that remembers, for every character, which source characters
it came from.  The same detectors run on that text, and what only shows there
is mapped back to spans of the source.  Whole texts are read; a text is judged
alone, so rows need no shuffle.  Every scan is linear in the text.
"""

import hashlib
import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ship, utf8

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]      # start, index in KINDS, end (exclusive), in code points

# ---------------------------------------------------------------- detectors
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ANY = re.compile(r"[0-9@]")


def _emails(text: str) -> list[Span]:
    # a match has one @, so its local part is the run of local characters before it
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            out.append((start, 0, past))
        at = text.find("@", max(at + 1, past))
    return out


def _ips(text: str) -> list[Span]:
    out = []
    for chain in _DOTTED.finditer(text):         # leftmost matches take four parts each from a dotted chain
        if "." not in chain[0]:
            continue
        parts, at, bounds = chain[0].split("."), chain.start(), []
        for part in parts:
            bounds.append((at, at + len(part)))
            at += len(part) + 1
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i:i + 4]):
                out.append((bounds[i][0], 1, bounds[i + 3][1]))
    return out


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _cards(text: str) -> list[Span]:
    out = []
    for m in _DIGIT_CHAIN.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    return out


def _phones(text: str) -> list[Span]:
    return [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]


def detect(text: str) -> list[Span]:
    """The plain identifiers of a text, by start and then kind."""
    if not _ANY.search(text):
        return []
    return sorted(_emails(text) + _ips(text) + _cards(text) + _phones(text))


# -------------------------------------------------------------- transducers
# fixed values: letters of other scripts that look like an ASCII letter
_LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "ս": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H",
    "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "α": "a",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g",
}
_DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
                "seven": "7", "eight": "8", "nine": "9"}
# fixed values: endings of addresses that a spelled "dot" may stand before, besides any two letters and "xn--"
_ENDINGS = ("com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat asia post xxx app dev "
            "page online site website web store shop xyz top club vip win work works live life news blog wiki cloud tech technology "
            "digital software systems solutions services service support agency company group global international world "
            "network email mail host hosting space icu fun link click email media studio design art photo photos photography "
            "gallery pictures video film music radio audio academy school college university education training science "
            "health healthcare clinic doctor dental hospital care fitness law legal lawyer attorney consulting finance financial "
            "bank money fund capital insurance credit loans tax accountant estate properties property house homes realty rent "
            "city town london berlin paris tokyo nyc africa istanbul moscow wien hamburg koeln bayern madrid amsterdam swiss "
            "ltd llc inc gmbh limited partners ventures holdings enterprises industries engineering energy solar green eco bio "
            "farm garden food restaurant bar pub cafe coffee pizza wine beer kitchen catering recipes fashion clothing shoes "
            "jewelry beauty hair boutique market marketing sale deals discount bargains gift gifts auction toys games game play "
            "casino bet poker sport sports football golf tennis run bike cars car auto autos taxi limo flights holiday "
            "vacations tours voyage cruises hotel camp church faith charity foundation ngo ong social community chat forum "
            "dating love family baby kids pet dog horse zone center institute expert guru ninja rocks cool "
            "today press report review reviews directory guide tips how plus pink red blue black gold one earth land sh "
            "events tickets party wedding cards express delivery supply supplies parts tools equipment construction builders "
            "contractors plumbing repair cleaning security protection computer codes data domains graphics ink mba "
            "example test invalid localhost local onion").split()
_WORD = "|".join(_DIGIT_WORDS)
_PART = rf"(?:{_WORD}|[0-9]++)(?![A-Za-z0-9])"
# two digit words or more, or one beside digits
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\s-]+(?=(?:{_WORD}|[0-9])))?{_PART}(?:[\s,-]++{_PART})+", re.I)
_SPELLED_PART = re.compile(rf"plus|{_WORD}|[0-9]+", re.I)
_TLD = rf"(?:{'|'.join(sorted(set(_ENDINGS), key=len, reverse=True))}|[a-z][a-z]|xn--[a-z0-9-]+)(?![A-Za-z0-9])"
_JOINED = re.compile(r"[A-Za-z0-9._%+-]+")
_ENDING = re.compile(_TLD, re.I)
# fixed values: endings that are words of everyday prose; spelled out without a sign they end no address
_PROSE = frozenset(
    "one today how plus work works live life news win top red pink blue black gold green love family baby care run play fun "
    "cool land link click page house home city town health food bar gift game games sale band school bike car cars hair market "
    "report review press events parts earth music photo pictures dog horse kids training support help wine beer coffee "
    "it is on so in at to me my no do be as am us by go he hi if of oh ok or ox up we an ah la ad id pa ma al de el en es et il "
    "je le lo mi ne ni nu os ou se si su sa ta te tu un va ya yo zu da du er ja ob um wo im ab um ed re ha ho hm eh uh".split())
# a spelled address is signed by a digit, a dot or an underscore in its name, or by such a word before it
_SIGNED_NAME = re.compile(r"[0-9._]")
_SIGN = re.compile(r"(?:e-?mails?|mails?|mailto|write|contact|reach|address|inbox)[ \t]*(?:(?:is|me|us|to|at|via|by|on)[ \t]*){0,2}[:=]?[ \t]*$",
                   re.I)
_AT_SIGN = re.compile(r"(?<=[A-Za-z0-9%+_-])[ \t]+@[ \t]+(?=[A-Za-z0-9-]+(?:(?:\.|[ \t]+dot[ \t]+)[A-Za-z0-9-]+)*[ \t]+dot[ \t]+[A-Za-z])", re.I)
_TEENS = dict(zip("ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), range(10, 20)))
_TENS = dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10)))
_NUMERAL = "|".join([*_DIGIT_WORDS, *_TEENS, *_TENS, "[0-9]{1,3}"])
_NUMBER = rf"(?:{_NUMERAL})(?:[ \t-]+(?:{_NUMERAL})){{0,2}}"
# four numbers in words or digits, three spelled dots, at least one number in words
_SPELLED_IP = re.compile(rf"(?<![A-Za-z0-9.])(?={_NUMBER}[ \t]+dot)({_NUMBER})[ \t]+dot[ \t]+({_NUMBER})[ \t]+dot[ \t]+({_NUMBER})"
                         rf"[ \t]+dot[ \t]+({_NUMBER})(?![A-Za-z0-9]|[ \t]+dot[ \t])", re.I)
_AT_BOX = re.compile(r"[(\[{<][ \t]*(?:at|@)[ \t]*[)\]}>]", re.I)
_DOT_BOX = re.compile(r"[(\[{<][ \t]*(?:dot|\.)[ \t]*[)\]}>]", re.I)
_DOT_NUMBER = re.compile(r"(?<=[0-9])[ \t]+dot[ \t]+(?=[0-9])", re.I)
_NAME, _LABEL = r"[A-Za-z0-9_%+-]+", r"[A-Za-z0-9-]+"
_DOT = r"(?:\.|[ \t]+dot[ \t]+)"
# spelled without brackets, "at" counts only before a spelled "dot" and an ending (``_spelled_ats`` looks at it)
_AT_WORDS = re.compile(rf"(?<=[A-Za-z0-9%+_-])[ \t]+at[ \t]+(?={_LABEL}(?:{_DOT}{_LABEL})*[ \t]+dot[ \t]+{_TLD})", re.I)
_LAST_LABEL = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})*[ \t]+dot[ \t]+({_TLD})", re.I)
_DOT_WORDS = re.compile(rf"@{_LABEL}(?:{_DOT}{_LABEL})*[ \t]+dot[ \t]+{_TLD}", re.I)
_DOT_BEFORE_AT = re.compile(rf"@{_NAME}(?:[ \t]+tod[ \t]+{_NAME})+", re.I)      # read from right to left
_DOT_WORD = re.compile(r"(?<![ \t])[ \t]+dot[ \t]+", re.I)
_BOX = re.compile(r"[(\[{<][ \t]*(?:at[ \t]*[)\]}>]|[@.])")
_DIGIT_SET = frozenset(_DIGIT_WORDS)


def _spelled(lower: str) -> bool:
    """Whether a digit word stands by itself (cheap; the transducer looks for the runs)."""
    return not _DIGIT_SET.isdisjoint(lower.replace(",", " ").replace("-", " ").split())


@lru_cache(maxsize=1)
def _characters() -> tuple[dict[str, str], re.Pattern]:
    """{character: ASCII it stands for}, by Unicode's own compatibility forms, and a pattern of these characters."""
    table = dict(_LOOKALIKES)
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Cf":
            table[c] = ""                        # zero-width and other invisible characters
        elif kind == "Nd":
            table[c] = str(unicodedata.digit(c))
        elif kind == "Pd":
            table[c] = "-"
        elif kind == "Zs":
            table[c] = " "
        elif kind != "Cn" and c not in table:
            plain = unicodedata.normalize("NFKC", c)
            if plain != c and len(plain) == 1 and plain.isascii() and plain.isprintable():
                table[c] = plain
    codes, spans = sorted(map(ord, table)), []
    for code in codes:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return table, re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(z))}" for a, z in spans) + "]")


class Mapped:
    """A text and, for every character, the source span that it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace disjoint spans, given in order; every new character stands for the whole replaced span."""
        if not edits:
            return
        text, start, end, at = [], [], [], 0
        for a, z, new in edits:
            text += (self.text[at:a], new)
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[z - 1]] * len(new)
            at = z
        self.text = "".join((*text, self.text[at:]))
        self.start, self.end = start + self.start[at:], end + self.end[at:]

    def each(self, pattern: re.Pattern, new: str, blanks: bool = False) -> None:
        """Replace every match, with the spaces and tabs around it if ``blanks``."""
        edits, text = [], self.text
        for m in pattern.finditer(text):
            a, z = m.span()
            while blanks and a > (edits[-1][1] if edits else 0) and text[a - 1] in " \t":
                a -= 1
            while blanks and z < len(text) and text[z] in " \t":
                z += 1
            edits.append((a, z, new))
        self.rewrite(edits)

    def inside(self, spans: list[tuple[int, int]], inner: re.Pattern, new: str) -> None:
        """Replace ``inner`` where it occurs in one of the spans."""
        self.rewrite([(m.start(), m.end(), new) for a, z in spans for m in inner.finditer(self.text, a, z)])


def _spelled_digits(mapped: Mapped) -> None:
    edits = []
    for run in _SPELLED.finditer(mapped.text):
        parts = list(_SPELLED_PART.finditer(mapped.text, run.start(), run.end()))
        for i, w in enumerate(parts):            # a word takes the separators beside it along
            after = parts[i + 1] if i + 1 < len(parts) else None
            past = after.start() if after else w.end()
            if not w[0].isdigit():
                edits.append((w.start(), past, _DIGIT_WORDS.get(w[0].lower(), "+")))
            elif after and not after[0].isdigit():
                edits.append((w.end(), past, ""))
    mapped.rewrite(edits)


def _joined_addresses(mapped: Mapped) -> None:
    """Addresses spelled in one word: name_at_host_dot_com, name-at-host-dot-com."""
    edits = []
    for word in _JOINED.finditer(mapped.text):
        if "dot" not in word[0].lower():
            continue
        for mark in "_-":
            parts = word[0].lower().split(mark)
            ats = [i for i, p in enumerate(parts) if p == "at"]
            dots = [i for i, p in enumerate(parts) if p == "dot"]
            if not ats or not dots or ats[-1] == 0 or dots[-1] < ats[-1] + 2 or dots[-1] + 2 != len(parts) \
                    or not _ENDING.fullmatch(parts[-1].rstrip(".")):
                continue
            at = word.start()
            for i, p in enumerate(parts):        # the separators on either side go with "at" and "dot"
                if i == ats[-1] or i in dots and i and i + 1 < len(parts):
                    edits.append((at - 1, at + len(p) + 1, "@" if p == "at" else "."))
                at += len(p) + 1
            break
    mapped.rewrite([e for i, e in enumerate(edits) if not i or e[0] >= edits[i - 1][1]])


def _number(words: str) -> str | None:
    """The number that digit words, or a ten with a unit, say; None if they say none."""
    parts = re.split(r"[ \t-]+", words.lower())
    if all(p in _DIGIT_WORDS for p in parts):
        return "".join(_DIGIT_WORDS[p] for p in parts)
    if len(parts) == 1:
        return str(_TEENS.get(words.lower(), _TENS.get(words.lower(), words)))
    if len(parts) == 2 and parts[0] in _TENS and parts[1] in _DIGIT_WORDS and parts[1] != "zero":
        return str(_TENS[parts[0]] + int(_DIGIT_WORDS[parts[1]]))
    return None


def _spelled_ips(mapped: Mapped) -> None:
    edits = []
    for m in _SPELLED_IP.finditer(mapped.text):
        numbers = [_number(g) for g in m.groups()]
        if None in numbers or all(g.isdigit() for g in m.groups()):
            continue
        for i, number in enumerate(numbers, 1):
            edits.append((m.start(i), m.end(i), number))
            if i < 4:
                edits.append((m.end(i), m.start(i + 1), "."))
    mapped.rewrite(edits)


def _spelled_ats(mapped: Mapped) -> None:
    """ " at " before a host with a spelled dot, unless the ending is a word of prose and nothing signs the address."""
    text, edits = mapped.text, []
    for m in _AT_WORDS.finditer(text):
        ending = _LAST_LABEL.match(text, m.end())[1].lower()
        if ending in _PROSE:
            start = m.start()
            while start > max(0, m.start() - 64) and text[start - 1] in _LOCAL:
                start -= 1
            if not (_SIGNED_NAME.search(text, start, m.start()) or _SIGN.search(text[max(0, start - 40):start])):
                continue
        edits.append((m.start(), m.end(), "@"))
    mapped.rewrite(edits)


def normalise(text: str) -> Mapped | None:
    """The normalised text with its source spans; None if nothing in ``text`` is disguised."""
    table, odd = _characters()
    strange = not text.isascii() and odd.search(text)
    lower = text.lower()
    if not (strange or "dot" in lower or _spelled(lower) or _BOX.search(lower)):
        return None
    mapped = Mapped(text)
    if strange:
        mapped.rewrite([(m.start(), m.end(), table[m[0]]) for m in odd.finditer(text)])
    if "dot" in lower:
        _spelled_ips(mapped)
    _spelled_digits(mapped)
    mapped.each(_AT_BOX, "@", blanks=True)
    mapped.each(_DOT_BOX, ".", blanks=True)
    mapped.each(_DOT_NUMBER, ".")
    _joined_addresses(mapped)
    mapped.each(_AT_SIGN, "@")
    _spelled_ats(mapped)
    mapped.inside([m.span() for m in _DOT_WORDS.finditer(mapped.text)], _DOT_WORD, ".")
    n, reverse = len(mapped.text), mapped.text[::-1]
    before = [(n - m.end(), n - m.start()) for m in _DOT_BEFORE_AT.finditer(reverse)]
    mapped.inside(before[::-1], _DOT_WORD, ".")
    return mapped if mapped.text != text else None


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, spans that only show in the normalised text), each by start and kind.

    A span is added only if its source differs from the identifier read there.
    Where a plain span of its kind overlaps, it must reach further, and not by a
    mere typographic dash or space.
    """
    base = detect(text)
    mapped = normalise(text)
    added = set()
    for a, kind, z in detect(mapped.text) if mapped else ():
        start, end = mapped.start[a], mapped.end[z - 1]
        source = text[start:end]
        met = [(s, e) for s, k, e in base if k == kind and s < end and start < e]
        beyond = text[start:min(s for s, _ in met)] + " " + text[max(e for _, e in met):end] if met else ""
        if source != mapped.text[a:z] and not (met and (
                any(s <= start and end <= e for s, e in met)
                or beyond.strip(" ,-\t\r\n").lower() in _DIGIT_WORDS              # "+1 212 555 0153, one of us"
                or any(unicodedata.category(c) in ("Pd", "Zs") and not c.isascii() for c in source))):
            added.add((start, kind, end))
    return base, sorted(added)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


_FOUND = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()),
                       T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())])


def _found(texts: pa.Array) -> pa.Array:
    rows = []
    for b in utf8(texts):
        base, added = find(b.decode())
        rows.append((*(sum(k == kind for _, kind, _ in base) for k in range(len(KINDS))),
                     hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), len(added)))
    columns = list(zip(*rows)) or [()] * len(_FOUND)
    kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_FOUND.names)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, plain counts per kind, base_sha256, spans (all), n_added.

    ``spans`` lists ``kind:start:end`` by start, then kind, in code points of the
    source with an exclusive end.  Null and empty texts have none; a very long
    text is read whole, in linear time; repeated rows get a row each and null ids stay null; an empty table gives an empty result;
    other columns of ``docs`` play no part.
    """
    ship(docs.sparkSession)
    f = free_name(docs, "found")
    return docs.select(F.col(id_col), F.arrow_udf(_found, _FOUND)(F.col(text_col)).alias(f)).select(id_col, f"{f}.*")


def redacted(text: Column) -> Column:
    """A text column with every span replaced by its kind in angle brackets; null stays null."""
    def replace(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts.to_pylist():
            if value is not None:
                base, added = find(value)
                parts, at = [], 0
                for a, kind, z in sorted(base + added):
                    if a >= at:
                        parts += (value[at:a], f"<{KINDS[kind]}>")
                    at = max(at, z)
                value = "".join((*parts, value[at:]))
            out.append(value)
        return pa.array(out, pa.string())

    return F.arrow_udf(replace, T.StringType())(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text_col`` replaced; all other columns as they are."""
    ship(docs.sparkSession)
    return docs.withColumn(text_col, redacted(F.col(text_col)))
