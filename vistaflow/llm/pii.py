"""Personal data in text, also where it is disguised; spans always refer to the source."""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right, insort
from functools import cache

from pyspark.sql import DataFrame

from vistaflow.llm.spans import Span, scan_spans

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from their at signs so that long runs cost linear time."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            found.append(Span("email", start, done))
        at = text.find("@", max(at + 1, done))
    return found


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The four kinds, each leftmost without overlaps; matches that fail a test are dropped."""
    found = emails(text)
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(Span("card", *m.span()))
    if "." in text:
        for m in IP.finditer(text):
            if all(map(small_number, m[0].split("."))):
                found.append(Span("ip", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return found


# Disguises. Lookalikes are Cyrillic and Greek letters drawn like Latin ones; full-width and
# mathematical forms follow from their compatibility decomposition. Fixed values.
LOOKALIKES = dict(zip("аеорсухіѕјԁһӏԛԝАВЕКМНОРСТХαοινρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aeopcyxisjdhlqwABEKMHOPCTXaoivpuABEZHIKMNOPTYX"))
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
               "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
WORD = "|".join(DIGIT_WORDS)
DIGIT_RUN = re.compile(rf"\b(?:plus[ -]+)?(?:(?:{WORD}|dot|[0-9])(?:[ ,.-]{{1,2}}|\b)){{4,}}", re.IGNORECASE)
DIGIT_PART = re.compile(rf"(plus)[ -]+|({WORD})|[ ,.-]*\b(dot)\b[ ,.-]*|[ ,]+", re.IGNORECASE)
# The same with numbers of several digits; a space after a stop stays, it may end a sentence.
NUMBER_RUN = re.compile(
    rf"\b(?:plus[ -]+)?(?:(?:{WORD}|dot|[0-9]++)(?:[ ,.-]{{1,2}}|\b)){{2,}}", re.IGNORECASE)
NUMBER_PART = re.compile(
    rf"(plus)[ -]+|({WORD})|[ ,.-]*\b(dot)\b[ ,.-]*|(?<!\.)[ ,]+", re.IGNORECASE)
BRACKETED = re.compile(r"(?:(?<![ \t])[ \t]++)?[\[({<][ \t]*(at|dot|@|\.)[ \t]*[\])}>][ \t]*", re.IGNORECASE)
SPACED = re.compile(
    r"(?<=[A-Za-z0-9])([ \t]+at[ \t]+|@)([A-Za-z0-9-]+(?:(?:\.|[ \t]+dot[ \t]+)[A-Za-z0-9-]+)+)(?![A-Za-z0-9])",
    re.IGNORECASE)
SPACED_DOT = re.compile(r"\.|[ \t]+dot[ \t]+", re.IGNORECASE)
# The same with wider signs: "_at_" and "_dot_", and an at sign and stops with space around them.
# A stop between spaces also ends sentences, so a common last label must follow it. Fixed values.
LAST_LABELS = ("com org net edu gov mil int info biz io co ai app dev me "
               "uk de fr nl es ru ch se pl jp cn br ca au eu").split()
MARKED = re.compile(
    r"(?<=[A-Za-z0-9])([ \t]*_at_[ \t]*|@)([A-Za-z0-9-]+(?:(?:\.|[ \t]*_dot_[ \t]*)[A-Za-z0-9-]+)+)(?![A-Za-z0-9])",
    re.IGNORECASE)
MARKED_DOT = re.compile(r"\.|[ \t]*_dot_[ \t]*", re.IGNORECASE)
PARTED = re.compile(
    r"(?<=[A-Za-z0-9])([ \t]*@[ \t]*)((?:[A-Za-z0-9-]+(?:\.|[ \t]+\.[ \t]+))+(?:%s))(?![A-Za-z0-9])" % "|".join(LAST_LABELS),
    re.IGNORECASE)
PARTED_DOT = re.compile(r"[ \t]*\.[ \t]*")
# Signs written as entities or percent codes, and characters that show nothing.
ESCAPED = re.compile(
    r"&#([0-9]{1,7});|&#x([0-9a-f]{1,6});|&(commat|period|plus|lowbar|hyphen);|%(40|2e|2b|5f|2d)", re.IGNORECASE)
ENTITIES = {"commat": "@", "period": ".", "plus": "+", "lowbar": "_", "hyphen": "-"}
UNSEEN = re.compile("[%s]+" % "".join(map(chr, (0xAD, 0x34F, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F),
                                                  *range(0x2060, 0x2070), 0xFEFF))))
# Letters drawn like digits, among digits.
LETTER_DIGITS = {"O": "0", "o": "0", "I": "1", "l": "1"}
MIXED_RUN = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?:[ .()-]{1,2}[0-9OoIl]++)*+(?![A-Za-z0-9])")
MIXED = re.compile(r"[0-9][ .()-]{0,2}[OoIl]|[OoIl][ .()-]{0,2}[0-9]")
# What may be a lookalike: beyond Latin letters, marks and general punctuation.
FOREIGN = f"[^\\x00-{chr(0x2FF)}{chr(0x2000)}-{chr(0x206F)}]"
ODD = re.compile(FOREIGN)


@cache
def plain(char: str) -> str:
    """A single ASCII character that looks like ``char``, or ``char`` itself."""
    known = LOOKALIKES.get(char)
    if known:
        return known
    folded = unicodedata.normalize("NFKC", char)
    if len(folded) == 1 and "!" <= folded <= "~":
        return folded
    if unicodedata.category(char) == "Nd":
        return str(unicodedata.digit(char))
    return char


class Rewritten:
    """A text after rewriting, with the source range of every character."""

    def __init__(self, text: str):
        self.text = text
        self.start = [0]  # begin of each piece here, in the source, and whether it is a copy
        self.source = [0]
        self.copied = [True]
        self.source_end = [len(text)]

    def apply(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """A text with ranges replaced; edits are in order and do not overlap."""
        out = Rewritten("")
        out.start, out.source, out.copied, out.source_end = [], [], [], []
        parts, size, done = [], 0, 0
        for low, high, new in [*edits, (len(self.text), len(self.text), "")]:
            for first, last in self._split(done, low):
                begin, end = self.span(first, last)
                out._add(size, begin, end, self.copied[bisect_right(self.start, first) - 1])
                parts.append(self.text[first:last])
                size += last - first
            if new:
                out._add(size, *self.span(low, high), False)
                parts.append(new)
                size += len(new)
            done = high
        out.text = "".join(parts)
        return out

    def _add(self, start: int, source: int, source_end: int, copied: bool):
        self.start.append(start)
        self.source.append(source)
        self.source_end.append(source_end)
        self.copied.append(copied)

    def _split(self, low: int, high: int):
        """The pieces of text[low:high], one for each piece it was made of."""
        while low < high:
            at = bisect_right(self.start, low)
            end = min(high, self.start[at] if at < len(self.start) else high)
            yield low, end
            low = end

    def span(self, low: int, high: int) -> tuple[int, int]:
        """Source range of text[low:high]; a replaced piece counts whole."""
        a, b = bisect_right(self.start, low) - 1, bisect_right(self.start, max(low, high - 1)) - 1
        begin = self.source[a] + (low - self.start[a] if self.copied[a] else 0)
        end = self.source[b] + (high - self.start[b]) if self.copied[b] else self.source_end[b]
        return begin, end

    def changed(self, low: int, high: int) -> bool:
        """Whether text[low:high] holds a replaced piece, or lost one inside."""
        a, b = bisect_right(self.start, low) - 1, bisect_right(self.start, max(low, high - 1)) - 1
        begin, end = self.span(low, high)
        return end - begin != high - low or not all(self.copied[a : b + 1])


def escaped(now: Rewritten) -> list[tuple[int, int, str]]:
    """Entities and percent codes of single printable characters, and of unseen ones."""
    found = []
    for m in ESCAPED.finditer(now.text):
        code = int(m[1]) if m[1] else int(m[2] or m[4] or "0", 16)
        new = ENTITIES[m[3].lower()] if m[3] else chr(code) if code <= sys.maxunicode else ""
        if new.isprintable() and new.strip() or UNSEEN.fullmatch(new):
            found.append((*m.span(), new))
    return found


def unseen(now: Rewritten) -> list[tuple[int, int, str]]:
    """Characters without width, which are taken out."""
    return [(*m.span(), "") for m in UNSEEN.finditer(now.text)]


def lookalikes(now: Rewritten) -> list[tuple[int, int, str]]:
    found = []
    for m in ODD.finditer(now.text):
        new = plain(m[0])
        if new != m[0]:
            found.append((m.start(), m.end(), new))
    return found


def bracketed(now: Rewritten) -> list[tuple[int, int, str]]:
    """At and dot in brackets."""
    return [(*m.span(), "@" if m[1].lower() in ("at", "@") else ".") for m in BRACKETED.finditer(now.text)]


def spaced(now: Rewritten) -> list[tuple[int, int, str]]:
    """At and dot as words, where both occur in one address or the other was in brackets."""
    found = []
    for m in SPACED.finditer(now.text):
        dots = [(m.start(2) + d.start(), m.start(2) + d.end()) for d in SPACED_DOT.finditer(m[2])]
        spans = [now.span(*d) for d in dots]
        if all(end - begin == 1 for begin, end in spans):
            continue  # "at example.com" is no disguise, its dots are plain
        if m[1] != "@":
            found.append((*m.span(1), "@"))
        found += [(*d, ".") for d in dots if now.text[d[0]] != "."]
    return found


def marked(now: Rewritten) -> list[tuple[int, int, str]]:
    """At and dot between low lines; "look_at_this.html" is no disguise, its dot is plain."""
    found = []
    for m in MARKED.finditer(now.text):
        dots = [(m.start(2) + d.start(), m.start(2) + d.end()) for d in MARKED_DOT.finditer(m[2])]
        edits = [(*m.span(1), "@")] * (m[1] != "@") + [(*d, ".") for d in dots if now.text[d[0]] != "."]
        if m[1][0] in " \t" or any(new == "." for *_, new in edits):
            found += edits
    return found


def parted(now: Rewritten) -> list[tuple[int, int, str]]:
    """Addresses with a stop, and perhaps the at sign, between spaces."""
    found = []
    for m in PARTED.finditer(now.text):
        dots = [(m.start(2) + d.start(), m.start(2) + d.end()) for d in PARTED_DOT.finditer(m[2])]
        edits = [(*d, ".") for d in dots if d[1] - d[0] > 1]
        if edits:
            found += [(*m.span(1), "@")] * (m[1] != "@") + edits
    return found


def letter_digits(now: Rewritten) -> list[tuple[int, int, str]]:
    """Letters for digits in runs of at least seven places, two thirds of them digits."""
    found = []
    for run in MIXED_RUN.finditer(now.text):
        letters = [m.span() for m in re.finditer("[OoIl]", run[0])]
        digits = sum(map(str.isdigit, run[0]))
        if letters and digits + len(letters) >= 7 and digits >= 2 * len(letters):
            found += [(run.start() + a, run.start() + b, LETTER_DIGITS[run[0][a]]) for a, b in letters]
    return found


def digit_words(now: Rewritten, run_of=DIGIT_RUN, part_of=DIGIT_PART) -> list[tuple[int, int, str]]:
    """Digits written as words, in runs of at least four; the words of a run are joined."""
    found = []
    for run in run_of.finditer(now.text):
        if not re.search(WORD, run[0], re.IGNORECASE):
            continue
        end = run.start() + len(run[0].rstrip(" ,.-"))
        for m in part_of.finditer(now.text, run.start(), end):
            new = "+" if m[1] else DIGIT_WORDS[m[2].lower()] if m[2] else "." if m[3] else ""
            found.append((*m.span(), new))
    return found


def number_words(now: Rewritten) -> list[tuple[int, int, str]]:
    """Digits written as words beside numbers of any length, in runs of at least two."""
    return digit_words(now, NUMBER_RUN, NUMBER_PART)


STEPS = (escaped, unseen, lookalikes, bracketed, marked, parted, spaced)
READINGS = (digit_words, number_words, letter_digits)  # of the same text; what an earlier one finds stays
SUSPECT = re.compile(
    rf"{FOREIGN}|{UNSEEN.pattern}|{ESCAPED.pattern}|_at_|_dot_|[ \t]\.[ \t]|{MIXED.pattern}|[\[({{<][ \t]*(?:at|dot|@|\.)[ \t]*[\])}}>]|[ \t]dot[ \t]"
    rf"|\b(?:{WORD})[ ,.-]{{1,2}}(?:{WORD}|[0-9]+)\b|\b[0-9]++[ ,.-]{{1,2}}(?:{WORD})\b",
    re.IGNORECASE)


def hidden_spans(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that show only after rewriting, as ranges of the source.

    Transducers rewrite the text one after the other, each keeping the source range of every
    piece; the last comes in two readings. What the plain search then finds over a rewritten
    piece is mapped back, and kept if no base span of its kind, or span of an earlier reading,
    overlaps it.
    """
    if not SUSPECT.search(text):
        return []
    now, edited = Rewritten(text), False
    for step in STEPS:
        edits = step(now)
        if edits:
            now, edited = now.apply(edits), True
    known: dict[str, list[Span]] = {}
    for span in base:
        known.setdefault(span.kind, []).append(span)
    found, read = [], []
    for reading in READINGS:
        edits = reading(now)
        if edits in read or not (edits or edited):
            continue
        read.append(edits)
        added = new_spans(now.apply(edits) if edits else now, known)
        for span in added:
            insort(known.setdefault(span.kind, []), span, key=lambda s: s.start)
        found += added
    return found


def new_spans(now: Rewritten, known: dict[str, list[Span]]) -> list[Span]:
    """Source ranges found over rewritten pieces, without those that meet a known span of their kind."""
    found = []
    for span in base_spans(now.text):
        if not now.changed(span.start, span.end):
            continue
        begin, end = now.span(span.start, span.end)
        near = known.get(span.kind, [])
        at = bisect_right(near, begin, key=lambda s: s.start)
        if (at == 0 or near[at - 1].end <= begin) and (at == len(near) or near[at].start >= end):
            found.append(Span(span.kind, begin, end))
    return found


def find_personal_data(text: str) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, hidden_spans(text, base)


def scan_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the plain identifiers; ``spans`` also holds those found behind
    lookalike and unseen characters, entities and percent codes, spelled digits, letters for
    digits, and disguised at and dot signs. Positions are code points of the source text. Null and empty texts have no spans; texts are taken whole.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    return scan_spans(docs, find_personal_data, KINDS, KINDS, id_col, text_col)
