"""Secrets in text, with multipart credentials linked by an interval join within scopes."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame

from vistaflow.llm.spans import Span, scan_spans

BASE = ("assign", "access", "hex")
LINKED = ("identifier", "secret", "endpoint")
MIN_SECRET, MIN_DISTINCT = 24, 10  # of a run that no name calls a secret

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

# Weak candidates: none of them is reported alone. Names may follow "_" and values "=".
IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9])(?:A[KS]IA[A-Z0-9]{12,}|(?:(?:client|account|tenant|access_?key|key|user)_?(?:id|name)|login|user)["']?"""
    r"""\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})""",
    re.ASCII | re.IGNORECASE,
)
NAMED = re.compile(
    r"""(?:pass(?:word|wd|phrase)|pwd|secret|token|(?:api|access|account|private|secret|signing)_?key)"""
    r"""(?:(?:_?access)?_?key|_?value)?["']?\x20*[:=]\x20*["']?"""
    r"""([^\s"'`,;<>{}()\[\]&]*[^\s"'`,;<>{}()\[\]&.:])""",
    re.ASCII | re.IGNORECASE,
)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}(?![A-Za-z0-9+/_=-])" % MIN_SECRET)
DIGEST = re.compile(r"[0-9A-Fa-f]+")
ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|(?:host|endpoint|server|region|url)["']?"""
    r"""\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]{4,})""",
    re.ASCII | re.IGNORECASE,
)
# An identifier holds one of these; a quick look that most texts fail.
LIKELY = re.compile(r"A[KS]IA|[:=]|-[0-9a-f]{4}-", re.ASCII | re.IGNORECASE)

BRACE = re.compile(r"[{}]")
HEADER = re.compile(r"[ \t]*\[{1,2}[^\[\]]+\]{1,2}[ \t\r]*")
COMMENT = re.compile(r"[ \t]*[#;]")
SETTING = re.compile(
    r"""[ \t]*(?:export[ \t]+)?["']?[A-Za-z_][A-Za-z0-9_.-]*+["']?[ \t]*[:=][ \t]*(?:"[^"]*"|'[^']*'|[^\s"']+)[,;]?[ \t\r]*""")


def base_spans(text: str) -> list[Span]:
    """The three plain kinds, each leftmost and without overlaps; short matches are dropped."""
    found = []
    if ":" in text or "=" in text:
        found += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def strong_enough(value: str) -> bool:
    """Whether a run looks random: enough different characters, of several classes; no digest."""
    classes = sum((any(map(str.isdigit, value)), value.upper() != value, value.lower() != value))
    return (classes >= 2 and any(map(str.isdigit, value)) and len(set(value)) >= MIN_DISTINCT
            and not DIGEST.fullmatch(value))


def apart(spans: list[tuple[int, int]], others: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that meet none of ``others``; both ascend without overlaps."""
    starts, ends = [s for s, _ in others], [e for _, e in others]
    return [s for s in spans if bisect_right(ends, s[0]) >= bisect_left(starts, s[1])]


def candidates(text: str) -> tuple[list[tuple[int, int]], ...]:
    """Identifiers, secrets and endpoints that may be parts of a credential.

    One range is one part: a value named as a secret is no identifier, and a random run
    inside an identifier, a named value or an endpoint is no second part of it.
    """
    identifiers = [m.span() for m in IDENTIFIER.finditer(text)]
    if not identifiers:
        return [], [], []
    named = [m.span(1) for m in NAMED.finditer(text)]
    identifiers = apart(identifiers, named)
    endpoints = [m.span() for m in ENDPOINT.finditer(text)]
    runs = [m.span() for m in RANDOM.finditer(text) if strong_enough(m[0])]
    for others in (identifiers, named, endpoints):
        runs = apart(runs, others)
    return identifiers, sorted(named + runs), endpoints


def closed_braces(text: str) -> list[tuple[int, int]]:
    """The outermost pairs of braces; one that is never closed, or never opened, is text."""
    opened, pairs = [], []
    for m in BRACE.finditer(text):
        if m[0] == "{":
            opened.append(m.start())
        elif opened:
            start = opened.pop()
            while pairs and pairs[-1][0] > start:
                pairs.pop()
            pairs.append((start, m.end()))
    return pairs


def scope_starts(text: str) -> list[int]:
    """Where scopes begin, ascending from 0.

    A scope is a paragraph, with these additions: a blank line inside a pair of braces ends
    nothing; nor does one between two settings (``name = value`` alone on a line, comments
    between them), which are one block of assignments; a ``[section]`` line begins a scope
    when a setting follows it, and blank lines before that setting belong to the section.
    """
    starts, braces = [0], closed_braces(text)
    brace_starts = [s for s, _ in braces]
    setting, blank, header, held = False, False, None, None
    at = 0
    # ``held`` is where comments or headers after a blank line begin; the next line decides on them.
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        if not text[at:end].strip(" \t\r"):
            blank = True
        elif HEADER.fullmatch(text, at, end):
            held = at if held is None and blank else held
            header, blank = at, False
        elif COMMENT.match(text, at, end):
            held = at if held is None and blank else held
            blank = False
        else:
            now = SETTING.fullmatch(text, at, end) is not None
            first = held if held is not None else at if blank else None
            start = header if now and header is not None else None if now and setting else first
            if start is not None:
                i = bisect_right(brace_starts, start) - 1
                if i < 0 or braces[i][1] <= start:
                    starts.append(start)
            setting, blank, header, held = now, False, None, None
        at = end + 1
    return sorted({*starts})


def linked_spans(text: str) -> list[Span]:
    """Parts of credentials that occur together.

    The intervals of identifiers and secrets, widened to their whole scope, are joined: both
    lists are ordered, so the partners of an interval are one range found by bisection. Every
    identifier with a secret and every secret with an identifier is reported, and every
    endpoint whose interval meets such a pair. Each candidate is looked at whole, however many
    there are and however far apart: a range is only tested for being empty, and pairs are not
    listed.
    """
    identifiers, secrets, endpoints = candidates(text)
    if not identifiers or not secrets:
        return []
    scopes = [*scope_starts(text), len(text)]

    def linked(spans, others) -> list[tuple[int, int]]:
        starts, found = [s for s, _ in others], []
        for span in spans:
            at = bisect_right(scopes, span[0])
            if bisect_left(starts, scopes[at - 1]) < bisect_left(starts, scopes[at]):
                found.append(span)
        return found

    kept_identifiers, kept_secrets = linked(identifiers, secrets), linked(secrets, identifiers)
    return [
        Span(kind, *span)
        for kind, spans in zip(
            LINKED, (kept_identifiers, kept_secrets, linked(endpoints, kept_secrets)))
        for span in spans
    ]


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """The plain spans, and the linked parts of credentials."""
    return base_spans(text), linked_spans(text) if LIKELY.search(text) else []


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` holds the base spans and the linked parts (identifier, secret, endpoint), as
    kind:start:end in code points; parts are linked within their whole scope: a paragraph,
    section, block of assignments or pair of braces. Null and empty texts have no spans; texts
    are taken whole. Repeated rows give repeated results, an empty table none; other columns
    are not read.
    """
    return scan_spans(docs, find_secrets, BASE, (*BASE, *LINKED), id_col, text_col)
