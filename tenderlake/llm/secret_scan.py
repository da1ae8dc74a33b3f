"""Secrets in texts: fixed formats, and random-looking strings by entropy.

Fixed formats come first and always stay. The entropy pass takes candidate
strings (runs of the characters that keys are written with), slides a window
over each and keeps the Shannon entropy of the window up to date by adding one
character's count and removing another's. A candidate is a secret when a window
exceeds the threshold of its character class, which follows from the number of
characters that the class draws from. Allow-listed candidates (plain words,
numbers, paths, addresses of the web, repeated filler) are passed over; letters
that change case more often than words do are no plain words. Letters of one
case alone look like a word: they count only after a name of a secret or an
assignment.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame

from .common import with_columns

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

WINDOW = 20
#: Bits a character that a window of 20 must reach, by character class: what at least 98 of 100 random strings
#: of 20 reach that are drawn from 16, 26, 32, 62 and 64 characters.
THRESHOLDS = {"hex": 2.8, "letters": 3.25, "one case": 3.4, "alnum": 3.6, "base64": 3.65}
ALLOW = re.compile(r"(?:[0-9]+|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(.{1,4})\1{4,}.{0,4}|[-_=+/]+)", re.S)
#: Runs of letters, or of letters and numbers apart: allowed where their case is that of words.
WORDS = re.compile(r"(?:[A-Za-z]+|(?:[A-Za-z]+[-_/=+])+[A-Za-z]*|(?:[A-Za-z]+|[0-9]+)(?:[-_/](?:[A-Za-z]+|[0-9]+))+)")
#: A word and a number on one side of it.
NUMBERED = re.compile(r"[A-Za-z]+[0-9]*|[0-9]+[A-Za-z]+")
#: What stands before a secret: its name, or an assignment.
CONTEXT = re.compile(r"""(?:key|secret|token|passw(?:or)?d|credential|auth|bearer)\W{1,4}$|[A-Za-z0-9_]["']?\x20?[:=]\x20?["']$|[A-Za-z0-9_]=$""", re.I | re.A)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Letters that words in camel case have on average, at least.
WORD_LETTERS = 4


def window_entropy(s: str, width: int = WINDOW) -> float:
    """The largest Shannon entropy, in bits a character, of the windows of width characters in s."""
    width = min(width, len(s))
    if not width:
        return 0.0
    count: dict[str, int] = {}
    term = [0.0] + [k * math.log2(k) for k in range(1, width + 1)]
    total = best = 0.0  # total: sum of count * log2(count)
    least = math.inf
    for i, c in enumerate(s):
        if i >= width:
            old = s[i - width]
            total += term[count[old] - 1] - term[count[old]]
            count[old] -= 1
        k = count.get(c, 0)
        total += term[k + 1] - term[k]
        count[c] = k + 1
        if i >= width - 1:
            least = min(least, total)
    best = math.log2(width) - least / width
    return best


def char_class(s: str) -> str:
    """hex, letters (of one case), one case (with numbers), alnum or base64: the narrowest class that holds all of s."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    if re.fullmatch(r"[0-9a-z]+|[0-9A-Z]+", s):
        return "letters" if s.isalpha() else "one case"
    return "alnum" if s.isalnum() else "base64"


def word_case(s: str) -> bool:
    """Whether the letters of s are of one case, or change case as seldom as words do."""
    if s.islower() or s.isupper():
        return True
    sizes = [len(w) for w in WORD.findall(s)]
    return sum(sizes) >= WORD_LETTERS * len(sizes)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        s = m.group().strip("-_=/+")
        if len(s) < WINDOW or ALLOW.fullmatch(s):
            continue
        kind, at = char_class(s), m.start() + m.group().index(s)
        if kind == "letters":
            if not CONTEXT.search(text[max(0, at - 24) : at]):
                continue
        elif WORDS.fullmatch(s) and word_case(s) or kind == "one case" and NUMBERED.fullmatch(s):
            continue
        if window_entropy(s) >= THRESHOLDS[kind]:
            out.append((at, at + len(s)))
    return out


def find(text: str | None, by_entropy: bool = True) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start and then kind. Null and empty texts have none.

    An entropy span is left out where it lies within a span of a fixed format.
    """
    if not text:
        return []
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if by_entropy:
        fixed = sorted((a, b) for _, a, b in spans)
        starts, reach = [a for a, _ in fixed], list(accumulate((b for _, b in fixed), max))
        spans += [("entropy", a, b) for a, b in entropy_spans(text) if not (k := bisect_right(starts, a)) or reach[k - 1] < b]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with overlapping spans merged and replaced by mark."""
    if text is None:
        return None
    out, at = [], 0
    for _, a, b in find(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _row() -> Callable[[str | None], tuple]:
    def one(text: str | None) -> tuple:
        spans = find(text)
        base = [s for s in spans if s[0] != "entropy"]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
        return (*n, hashlib.sha256(said.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans))

    return one


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256 and spans; columns of those names are replaced.

    Null and empty texts have none. Very long texts are scanned whole, each row
    for itself, so repeated rows have the same spans. An empty table gives an
    empty result. No other column's name clashes.
    """
    return with_columns(docs, text, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", _row, keep)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the secrets in its text column replaced; a column n_chars follows the new text."""
    size = ["n_chars"] if "n_chars" in docs.columns else []

    def row() -> Callable[[str | None], tuple]:
        def one(x: str | None) -> tuple:
            y = redacted(x)
            return (y, None if y is None else len(y))[: 1 + len(size)]

        return one

    return with_columns(docs, text, f"`{text}` string" + ", n_chars long" * len(size), row).select(*docs.columns)
