"""Personal data with offset-preserving deobfuscation.

Identifiers are found in the text as it is (the base spans) and again in a normalised text. Transducers normalise:
look-alike letters and digits and invisible characters, spelled digits, and disguises of @ and of dots. Each keeps,
for every character it writes, the stretch of source it stands for, so a span found in the normalised text maps back
to the source. Spans that owe nothing to a transducer are base spans already; the others are added unless they touch
a base span of their kind. What a transducer does is decided match by match, never by what else the text holds.

Scale: a map over the scan; a text is held once more in normalised form and only where a cheap test finds a trigger.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
SLICE = 256

#: Digits as English, German, French and Spanish spell them.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
#: Letters of other scripts that look like these.
LOOKALIKE = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονα" + "∙․。．＠",
        "ABESIJKMHOPCTYXaesijopcyxdqw" + "ABEZHIKMNOPTYXova" + "....@",
        strict=True,
    )
)
#: Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"

#: Endings after which bare words "at" and "dot" are read as an address.
ENDINGS = frozenset("com org net edu gov info biz io co me tv eu de at ch fr es it nl be pl se dk uk us ca au br mx ar jp cn in ru".split())

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

BRACKETS = r"[\(\[\{<]\s*+(?:%s)\s*+[\)\]\}>]"
AT_BRACKETS = re.compile(BRACKETS % "at|@", re.I)
DOT_BRACKETS = re.compile(BRACKETS % r"dot|punkt|point|punto|\.", re.I)
BARE = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+( at )[A-Za-z0-9-]+((?: dot [A-Za-z0-9-]+)+)(?![A-Za-z0-9-])", re.I)
DOT_WORD = re.compile(r" dot ", re.I)
#: Words of an address joined by " dot ".
CHAIN = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+@-]++(?: dot [A-Za-z0-9._%+@-]++)++", re.I)
DOT_WORDS = ("dot", "punkt", "point", "punto")
DOT_DIGITS = re.compile(rf"(?<=[0-9])\s++(?:{'|'.join(DOT_WORDS)})\s++(?=[0-9])", re.I)
NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
RUN = re.compile(rf"(?<!\w)(?:(?:{NUMBER}|plus|dot|punkt|point|punto|[0-9]+)(?!\w)[\s,-]*){{4,}}", re.I)
PART = re.compile(rf"(?:{NUMBER}|plus|dot|punkt|point|punto)(?!\w)", re.I)
#: Digits and spelled digits with whatever may stand between the digits of a number or an address.
WIDE = re.compile(rf"(?:(?:(?<!\w)(?:{NUMBER}|plus|dot|punkt|point|punto)(?!\w)|[0-9]++)[\s,.()+-]*+){{2,}}+", re.I)
WIDE_PART = re.compile(rf"(?<!\w)(?:{NUMBER}|plus|dot|punkt|point|punto)(?!\w)|[0-9]++", re.I)
GAP = " ,-\t\n"

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Left of each @ the run of local characters not yet used, right of it the domain."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def _address(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _luhn(text: str) -> bool:
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def detect(text: str) -> dict[str, list[Span]]:
    """Spans per kind, leftmost and without overlap; a match that fails its check is dropped for good."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if DIGIT.search(text):
        found["ip"] = [m.span() for m in IP.finditer(text) if _address(m[0])]
        found["card"] = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 13 and _luhn(m[0])]
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return found


class Traced:
    """A text with, per character, the stretch of source it stands for, and whether a transducer wrote it."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start = range(len(text))
        self.end = range(1, len(text) + 1)
        self.new: bytearray | None = None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Traced:
        """Replace the stretches; every character written stands for the whole stretch replaced."""
        if not edits:
            return self
        parts: list[str] = []
        start: list[int] = []
        end: list[int] = []
        new = bytearray()
        old = self.new or bytearray(len(self.text))
        at = 0
        for low, high, by in [*edits, (len(self.text), len(self.text), "")]:
            parts.append(self.text[at:low])
            start += self.start[at:low]
            end += self.end[at:low]
            new += old[at:low]
            if by:
                parts.append(by)
                start += [self.start[low]] * len(by)
                end += [self.end[high - 1]] * len(by)
                new += b"\x01" * len(by)
            at = high
        made = Traced("".join(parts))
        made.start, made.end, made.new = start, end, new
        return made


@lru_cache(maxsize=1)
def _characters() -> tuple[re.Pattern, dict[str, str]]:
    """Look-alikes by table, full-width forms and foreign digits by rule, invisible characters to nothing."""
    table = {**LOOKALIKE, **{c: "" for c in INVISIBLE}}
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    table |= {chr(c): str(unicodedata.digit(chr(c))) for c in range(0x80, 0x1FBFA) if unicodedata.category(chr(c)) == "Nd"}
    return re.compile("[" + re.escape("".join(sorted(table))) + "]"), table


def _bracketed(text: str, pattern: re.Pattern, by: str) -> list[tuple[int, int, str]]:
    """Every match and the white space around it. The bracket is looked for first, so blanks are walked over once."""
    edits, last = [], 0
    for m in pattern.finditer(text):
        low, high = m.span()
        while low > last and text[low - 1].isspace():
            low -= 1
        while high < len(text) and text[high].isspace():
            high += 1
        edits.append((low, high, by))
        last = high
    return edits


def _addresses(text: str) -> list[tuple[int, int, str]]:
    """The " dot " of every chain with an @; one that would join a second address to the first stays."""
    edits = []
    for chain in CHAIN.finditer(text):
        dots = [(d.start() + chain.start(), d.end() + chain.start()) for d in DOT_WORD.finditer(chain[0])]
        ends = [low for low, _ in dots[1:]] + [chain.end()]
        known = "@" in text[chain.start() : dots[0][0]]
        if not known and "@" not in chain[0]:
            continue
        for (low, high), end in zip(dots, ends, strict=True):
            more = "@" in text[high:end]
            if not (known and more):
                edits.append((low, high, "."))
            known |= more
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits of runs that spell four or more."""
    edits = []
    for run in RUN.finditer(text):
        words = list(PART.finditer(text, *run.span()))
        if sum(m[0].lower() in SPELLED for m in words) < 4:
            continue
        for m in words:
            low = m[0].lower()
            by = SPELLED.get(low) or ("+" if low == "plus" else ".")
            high = m.end()
            while high < run.end() and text[high] in GAP:
                high += 1
            edits.append((m.start(), high if high < run.end() else m.end(), by))
    return edits


def _partly_spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits of all runs that have the digits of a number, or those and the dots of an address, in whatever form."""
    edits = []
    for run in WIDE.finditer(text):
        parts = list(WIDE_PART.finditer(text, *run.span()))
        words = [SPELLED.get(m[0].lower()) or ("" if m[0][0].isdigit() else "+" if m[0].lower() == "plus" else ".") for m in parts]
        if not any(words):
            continue
        digits = sum(len(m[0]) if not by else by.isdigit() for m, by in zip(parts, words, strict=True))
        if digits < 9 and (digits < 4 or words.count(".") + run[0].count(".") < 3):
            continue
        for k, (m, by) in enumerate(zip(parts, words, strict=True)):
            if k and (by or words[k - 1]):
                low, high = parts[k - 1].end(), m.start()
                while low < high and text[low] in GAP:
                    low += 1
                if low > parts[k - 1].end():
                    edits.append((parts[k - 1].end(), low, ""))
                while high > low and text[high - 1] in GAP:
                    high -= 1
                if high < m.start():
                    edits.append((high, m.start(), ""))
            if by:
                edits.append((*m.span(), by))
    return edits


def normalise(text: str) -> list[Traced]:
    """The transducers one after another, each only where its trigger occurs.

    A transducer may also spoil what the ones before it laid open, by a further digit beside a number. So there are
    up to three texts, most trusted first: with runs of spelled digits undone, with all spelled digits undone, and
    with nothing but characters and brackets undone.
    """
    now = Traced(text)
    if not text.isascii():
        pattern, table = _characters()
        now = now.rewrite([(*m.span(), table[m[0]]) for m in pattern.finditer(now.text)])
    now = now.rewrite(_bracketed(now.text, AT_BRACKETS, "@"))
    now = now.rewrite(_bracketed(now.text, DOT_BRACKETS, "."))
    first = now
    lower = now.text.lower()
    if " dot " in lower:
        if " at " in lower:
            edits = []
            for m in BARE.finditer(now.text):
                if m[2].rpartition(" ")[2].lower() not in ENDINGS:
                    continue
                edits.append((*m.span(1), "@"))
                edits += [(d.start() + m.start(2), d.end() + m.start(2), ".") for d in DOT_WORD.finditer(m[2])]
            now = now.rewrite(edits)
        if "@" in now.text:
            now = now.rewrite(_addresses(now.text))
    if any(w in lower for w in DOT_WORDS):
        now = now.rewrite([(*m.span(), ".") for m in DOT_DIGITS.finditer(now.text)])
    found = [now]
    for mark in ",-.()+":
        lower = lower.replace(mark, " ")
    words = set(lower.split())
    if not words.isdisjoint(SPELLED):
        narrow, wide = _spelled(now.text), _partly_spelled(now.text)
        found = [now.rewrite(narrow)]
        if wide:
            found.append(now.rewrite(wide))
    if found[0] is not first or len(found) > 1:
        found.append(first)
    return [t for t in found if t.new is not None]


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and the spans that deobfuscation adds, in code points of the text."""
    base = detect(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    taken = {k: sorted(v) for k, v in base.items()}  # apart from one another, so neighbours tell what is touched
    for now in normalise(text):
        for kind, spans in detect(now.text).items():
            for a, b in spans:
                low, high = now.start[a], now.end[b - 1]
                if not any(now.new[a:b]) and high - low == b - a:  # a longer stretch of source has lost characters
                    continue
                if kind == "email" and not now.text[a:b].rpartition(".")[2].isalpha():
                    continue
                at = bisect_left(taken[kind], (low, high))
                if any(low < y and x < high for x, y in taken[kind][max(0, at - 1) : at + 1]):
                    continue
                taken[kind].insert(at, (low, high))
                added[kind].append((low, high))
    return base, added


def digest(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            found = [find(t or "") for t in part.column(1).to_pylist()]
            both = [{k: base[k] + added[k] for k in KINDS} for base, added in found]
            columns = [pa.array([len(base[k]) for base, _ in found], pa.int64()) for k in KINDS]
            columns.append(pa.array([hashlib.sha256(digest(base).encode()).hexdigest() for base, _ in found], pa.string()))
            columns.append(pa.array([digest(x) for x in both], pa.string()))
            columns.append(pa.array([sum(map(len, added.values())) for _, added in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256, spans (base and added), n_added for every row (doc_id, text).

    NULL and empty texts have no spans. Positions are code points, ends exclusive. NULL or repeated ids stay as
    they are; other columns are ignored. An empty table gives no rows. A very long text is scanned whole, in time
    that grows with its length, runs of white space and of digits included.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def redact(text: str, mark: str = "[{}]") -> str:
    """The text with every found span replaced by the name of its kind."""
    base, added = find(text)
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k in KINDS for a, b in base[k] + added[k]):
        if a >= at:
            out += [text[at:a], mark.format(kind)]
            at = b
    return "".join([*out, text[at:]])
