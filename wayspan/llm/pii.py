"""Personal data: exact base patterns, and disguised forms found by deobfuscation.

Each transducer rewrites the text and carries, for every output character, the
source characters it stands for; identifiers found in the rewritten text are
mapped back to spans (code points, end exclusive) of the source.

Undone are homoglyphs, full-width forms, other scripts' digits, invisible
characters, names of digits and of "plus", "at" and "dot" in four languages, and the
letters O, o, I, l within numbers.

Defined cases: null and empty texts have no spans; a very long text is one row, read
in one pass for each transducer; of spans of one kind that overlap, the base one
stays, of equal starts there is one; repeated rows are treated alike, each by itself;
an empty table gives an empty result; extra columns of any name and type are
ignored, or kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters that look like Latin ones, and the digits' names.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ո": "n", "ɡ": "g", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "\u2024": ".", "\u3002": ".", "\uff61": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
# English, German, French, Spanish.
NUMERALS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
PLUS = ("plus", "más", "mas")
AT_NAMES = ("at", "ät", "arobase", "arroba", "klammeraffe")
DOT_NAMES = ("dot", "punkt", "point", "punto")
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"

#: Last labels of a host that make words joined by a bare "at" and "dot" an address, whatever the words.
LAST_LABELS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in ru br ch at be se no dk fi pl pt cz me tv app dev example test".split())
# Words that tell prose from an address joined by a bare "at": before it, as a label of the host, and as its last label.
NO_LOCAL = frozenset(
    "a about all also and are arrive arrived arrives as available be been being both but by down error even exception failed for found from glance glanced go gone had has have he her here him his hosted how i in is it its just laugh laughed least like line lived lives look looked looking looks me meet meeting "
    "met more most no not now of off on once only online or our pointed pointing registered released seen she shouted smiled so sold stare stared stay stayed stopped stored studied than that the them then there these they this those to today us was we were what when where which while who with worked working works yet you".split()
)
NO_HOST = frozenset("a about all an and any are as at be but by each every for from had has have he her his how i if in into is its last least my no not of on or our she so some such than that the their them then there these they this those to was we were what when where which while who with you your".split())
#: Words of prose that are countries' labels as well.
COUNTRIES = frozenset("as at be by in is my no so to".split())
#: Ends of file names.
NO_LAST = frozenset("cpp css csv exe htm html java jpg js json pdf php png ts txt xml".split())

FOLD = {ord(k): v for k, v in HOMOGLYPHS.items()}
FOLD |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
FOLD |= {lo + d: str(d) for lo in (0x0660, 0x06F0, 0x0966) for d in range(10)}  # digits of other scripts
_ODD = re.compile("[" + "".join(map(re.escape, map(chr, FOLD))) + INVISIBLE + "]")
_HIDDEN = re.compile(f"[{INVISIBLE}]+")

_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_NUMERAL = "|".join(sorted(NUMERALS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<![{_L}])(?:{_NUMERAL})(?:[\s,-]+(?:{_NUMERAL}|[0-9])(?![{_L}]))+", re.IGNORECASE)
_NAMES = frozenset(NUMERALS)
_ONE = re.compile(rf"({_NUMERAL})|[0-9]", re.IGNORECASE)
_PLUS = re.compile(rf"(?<![{_L}0-9])(?<![0-9][ \t])(?:{'|'.join(PLUS)})[ \t]+(?=[0-9])", re.IGNORECASE)
#: Numbers with letters that look like 0 and 1.
_LETTERED = re.compile(r"(?<![A-Za-z0-9.])(?=[OoIl.]*[0-9])[0-9OoIl]++(?:\.[0-9OoIl]++)*+(?![A-Za-z0-9])")
_LIKE_DIGITS = str.maketrans("OoIl", "0011")
_O, _C = r"[\[({<]", r"[\])}>]"
_AT, _DOT = "|".join(AT_NAMES), "|".join(DOT_NAMES)
_AT_TAG = re.compile(rf"\s*{_O}\s*(?:{_AT}|@)\s*{_C}\s*|\s*_at_\s*|(?<=[A-Za-z0-9])[ \t]+(?:arobase|arroba|klammeraffe)[ \t]+(?=[A-Za-z0-9])", re.IGNORECASE)
_DOT_TAG = re.compile(rf"\s*{_O}\s*(?:{_DOT}|\.)\s*{_C}\s*|\s*_dot_\s*", re.IGNORECASE)
_DOT_WORD = re.compile(r"(?<=[A-Za-z0-9])[ \t]+dot[ \t]+(?=[A-Za-z0-9])", re.IGNORECASE)
#: A bare "at" counts only before a dotted host, whether its dots are disguised or not, that is no local part itself.
_AT_WORD = re.compile(r"(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=[A-Za-z0-9-]++(?:[.\x00][A-Za-z0-9-]++)++(?![A-Za-z0-9._%+-]*@|[ \t]+(?:at|@)[ \t]+[A-Za-z0-9-]+[.\x00]))", re.IGNORECASE)
#: In the source: a bare "at" before a plain dot.
_AT_PLAIN = re.compile(r"[A-Za-z0-9][ \t]+at[ \t]+[A-Za-z0-9-]+\.[A-Za-z0-9]", re.IGNORECASE)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])[ \t]+@[ \t]+(?=[A-Za-z0-9-]+[.\x00])")
#: Dots of any language spelled out beside an undisguised at, in the host or in the local part.
_HOST_DOTS = re.compile(rf"(?<=@)[A-Za-z0-9-]+(?:(?:[.\x00]|[ \t]+(?:{_DOT})[ \t]+)[A-Za-z0-9-]+)+", re.IGNORECASE)
_LOCAL_DOTS = re.compile(rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]++(?:[ \t]++(?:{_DOT})[ \t]++[A-Za-z0-9_%+-]++){{1,8}}(?=@)", re.IGNORECASE)
_SPACED_DOT = re.compile(rf"[ \t]+(?:{_DOT})[ \t]+", re.IGNORECASE)
_MARKED = re.compile("[@\uff20_\\[\\](){}<>]|arobase|arroba|klammeraffe", re.IGNORECASE)
_HINT = re.compile(rf"{_O}\s*(?:{_AT}|{_DOT}|@|\.)\s*{_C}|_at_|_dot_|\sdot\s|\s@\s|\s(?:arobase|arroba|klammeraffe)\s|@\S+\s+(?:{_DOT})\s", re.IGNORECASE)
_HINT_FAST = ("@", "_at_", "_dot_", " dot", "\tdot", "\ndot", "arroba", "arobase", "klammeraffe", "(", "[", "{", "<")
#: Two names of digits in a row, or one beside a digit.
_NUM_HINT = re.compile(rf"(?<![{_L}])(?:{_NUMERAL})[\s,-]+(?:[0-9]|(?:{_NUMERAL})(?![{_L}]))", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind, each leftmost and not overlapping within its kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        at = 0
        for m in _DOMAIN.finditer(text):
            s = m.start()
            while s > at and text[s - 1] in _LOCAL:
                s -= 1
            if s < m.start():
                out["email"].append((s, m.end()))
                at = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, at = m.group().split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out["ip"].append((at, end))
                at = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out["phone"].append(m.span())
    return out


class Tape:
    """A rewritten text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1

    def fold(self) -> None:
        """One character for one: offsets stay."""
        self.text = self.text.translate(FOLD)

    def rewrite(self, pattern: re.Pattern, to, each: bool = False) -> None:
        """Replace each match by ``to(match)``: its characters all stand for the whole match, or, with ``each``, one for one."""
        texts, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = to(m)
            if new == m.group() or m.end() == m.start():
                continue
            a, z = m.span()
            texts += [self.text[at:a], new]
            starts += [self.start[at:a], self.start[a:z] if each else np.full(len(new), self.start[a])]
            ends += [self.end[at:a], self.end[a:z] if each else np.full(len(new), self.end[z - 1])]
            at = z
        if texts:
            self.text = "".join([*texts, self.text[at:]])
            self.start = np.concatenate([*starts, self.start[at:]])
            self.end = np.concatenate([*ends, self.end[at:]])

    def spelled(self) -> None:
        """Names of digits in a row become digits, each standing for its own name; names side by side lose what parts them."""
        texts, starts, ends, at = [], [], [], 0
        for m in _SPELLED.finditer(self.text):
            ones = list(_ONE.finditer(self.text, *m.span()))
            first = np.array([x.start() for x in ones])
            last = np.array([x.end() - 1 for x in ones])
            texts += [self.text[at : m.start()], "".join(NUMERALS[x.group().lower()] if x.group(1) else x.group() for x in ones)]
            starts += [self.start[at : m.start()], self.start[first]]
            ends += [self.end[at : m.start()], self.end[last]]
            at = m.end()
        if texts:
            self.text = "".join([*texts, self.text[at:]])
            self.start = np.concatenate([*starts, self.start[at:]])
            self.end = np.concatenate([*ends, self.end[at:]])

    def dots(self, pattern: re.Pattern) -> None:
        """Dots spelled out within each match become dots."""
        places = [(d.start(), d.end()) for m in pattern.finditer(self.text) for d in _SPACED_DOT.finditer(self.text, *m.span())]
        texts, keep, at = [], np.ones(len(self.text), bool), 0
        for a, z in places:
            texts += [self.text[at:a], "\0"]
            self.end[a] = self.end[z - 1]
            keep[a + 1 : z] = False
            at = z
        if places:
            self.text = "".join([*texts, self.text[at:]])
            self.start, self.end = self.start[keep], self.end[keep]


def disguised(text: str) -> bool:
    """Whether any transducer may find something; cheap tests first."""
    low = text if text.islower() else text.lower()
    if not text.isascii() and _ODD.search(text):
        return True
    if any(h in low for h in _HINT_FAST) and _HINT.search(low):
        return True
    if not _NAMES.isdisjoint(low.replace(",", " ").replace("-", " ").split()) and _NUM_HINT.search(low):
        return True
    if _DIGIT.search(text) and (any(x in low for x in PLUS) and _PLUS.search(text) or any(not x.replace(".", "").isdigit() for x in _LETTERED.findall(text))):
        return True
    return (" at" in low or "\tat" in low) and bool(_AT_PLAIN.search(low))


def likely(address: str, plain: bool) -> bool:
    """Whether words joined by a bare "at" are an address rather than prose; ``plain`` if its dot was not disguised."""
    local, _, host = address.partition("@")
    labels = host.split(".")
    last = labels[-1]
    if not plain and last.lower() in LAST_LABELS:
        return True
    if not (last.isascii() and last.isalpha() and len(last) >= 2) or local.lower() in NO_LOCAL or any(x.lower() in NO_HOST for x in labels[:-1]):
        return False
    if last.lower() in NO_LAST or last.lower() in NO_HOST - COUNTRIES:
        return False
    # "at noon.Then": a plain dot before a capital ends a sentence
    return not (plain and last[0].isupper() and labels[-2][:1].islower())


def deobfuscated(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the source found after rewriting."""
    tape = Tape(text)
    if not text.isascii():
        tape.fold()
        tape.rewrite(_HIDDEN, lambda _: "")
    tape.rewrite(_LETTERED, lambda m: m.group().translate(_LIKE_DIGITS), each=True)
    tape.spelled()
    tape.rewrite(_PLUS, lambda _: "+")
    tape.rewrite(_AT_TAG, lambda _: "@")
    # \0 marks a disguised dot until the bare "at" has been judged
    tape.rewrite(_DOT_TAG, lambda _: "\0")
    tape.rewrite(_DOT_WORD, lambda _: "\0")
    tape.rewrite(_AT_WORD, lambda _: "@")
    tape.rewrite(_SPACED_AT, lambda _: "@")
    tape.dots(_HOST_DOTS)
    tape.dots(_LOCAL_DOTS)
    tape.text = tape.text.replace("\0", ".")
    out: dict[str, list[tuple[int, int]]] = {}
    for kind, spans in detect(tape.text).items():
        found = [(int(tape.start[a]), int(tape.end[z - 1]), tape.text[a:z]) for a, z in spans]
        if kind == "email":
            kept = []
            for f in found:
                plain = bool(_AT_PLAIN.search(text, f[0], f[1]))
                if _MARKED.search(text, f[0], f[1]) and not plain or likely(f[2], plain):
                    kept.append(f)
            found = kept
        out[kind] = [f[:2] for f in found]
    return out


def find(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """(base spans, added spans) by kind."""
    text = text or ""
    base = detect(text)
    added: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if disguised(text):
        for kind, spans in deobfuscated(text).items():
            # both lists are in order and without overlaps
            taken, after = base[kind], 0
            for a, z in spans:
                k = bisect_left(taken, (z,))
                if a >= after and (not k or taken[k - 1][1] <= a):
                    added[kind].append((a, z))
                    after = z
    return base, added


def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k in KINDS for a, z in spans[k])


def spans_of(docs: DataFrame) -> DataFrame:
    """Per document: counts and digest of base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                base, added = find(text.as_py())
                code = joined(base)
                n = sum(map(len, added.values()))
                every = joined({k: sorted(base[k] + added[k]) for k in KINDS}) if n else code
                rows.append((doc, *(len(base[k]) for k in KINDS), hashlib.sha256(code.encode()).hexdigest() if code else none, every, n))
            if rows:
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first, then longest."""
    base, added = find(text)
    spans = sorted((a, -z, k) for k in KINDS for a, z in base[k] + added[k])
    out, at = [], 0
    for a, neg, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = -neg
        else:
            at = max(at, -neg)
    return "".join([*out, text[at:]]) if spans else text


def mask(docs: DataFrame) -> DataFrame:
    """All rows with their spans masked; ``n_chars``, if there, is set anew where the text changes."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column("text").to_pylist()
            new = [masked(t) if t else t for t in old]
            cols = list(b.columns)
            cols[names.index("text")] = pa.array(new, b.column("text").type)
            if "n_chars" in names:
                was = b.column("n_chars").to_pylist()
                cols[names.index("n_chars")] = pa.array([w if n is o or n == o else len(n) for w, n, o in zip(was, new, old, strict=True)], b.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, docs.schema)
