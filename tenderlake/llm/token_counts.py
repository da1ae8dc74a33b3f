"""Token counts under a byte-level BPE vocabulary.

Offline, every vocabulary string is merged by itself; those that end as one
token are whole tokens. A text is cut into pre-tokens; a pre-token that is a
whole token counts one without any merging, and only the rest are merged. What
a merged pre-token counts is kept for the task, up to a bound.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable

import regex
from pyspark.sql import DataFrame

from .common import with_columns

PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Pre-tokens whose counts a task keeps, and the longest of them.
KEPT, KEPT_LENGTH = 500_000, 64
#: Up to this length a scan beats a heap.
SHORT = 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merged_length(letters: str, ranks: dict[tuple[str, str], int]) -> int:
    """The number of tokens after merging, lowest rank first and leftmost among equals."""
    return _merged_short(letters, ranks) if len(letters) <= SHORT else _merged_long(letters, ranks)


def _merged_short(letters: str, ranks: dict[tuple[str, str], int]) -> int:
    """By scanning the ranks of all neighbours for the lowest."""
    parts, rank, never = list(letters), ranks.get, len(ranks)
    found = [rank(p, never) for p in zip(parts, parts[1:])]
    while found and (least := min(found)) < never:
        i = found.index(least)
        parts[i] += parts.pop(i + 1)
        found.pop(i)
        if i < len(found):
            found[i] = rank((parts[i], parts[i + 1]), never)
        if i:
            found[i - 1] = rank((parts[i - 1], parts[i]), never)
    return len(parts)


def _merged_long(letters: str, ranks: dict[tuple[str, str], int]) -> int:
    """By a heap of neighbours, in time near the length."""
    parts: list[str | None] = list(letters)
    n = len(parts)
    if n < 2:
        return n
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        left -= 1
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (r := ranks.get((parts[x], parts[y]))) is not None:
                heapq.heappush(heap, (r, x, parts[x], parts[y]))
    return left


class Counter:
    """Counts tokens. Its tables are as large as the vocabulary, whatever the corpus."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(made["model"]["merges"])}
        self.special = [t["content"] for t in made["added_tokens"]]
        self.letters = byte_letters()
        byte = {c: b for b, c in enumerate(self.letters)}
        self.whole = frozenset(self._proved(made["model"]["vocab"], byte))

    def _proved(self, vocab: Iterable[str], byte: dict[str, int]) -> Iterable[str]:
        """Vocabulary strings that are one pre-token and that merge into one token."""
        for token in vocab:
            try:
                text = bytes(byte[c] for c in token).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if PRE_TOKEN.fullmatch(text) and PRE_TOKEN.findall(text) == [text] and merged_length(token, self.ranks) == 1:
                yield text

    def counter(self) -> Callable[[str], int]:
        """A function from a text to its number of tokens."""
        letters, ranks = self.letters, self.ranks

        class Table(dict):
            """Counts by piece; what is absent is counted by make and kept."""

            def __init__(self, known: dict[str, int], make: Callable[[str], int]):
                super().__init__(known)
                self.make = make

            def __missing__(self, piece: str) -> int:
                n = self.make(piece)
                if len(piece) <= KEPT_LENGTH and len(self) < KEPT:
                    self[piece] = n
                return n

        merged = Table({}, lambda x: merged_length("".join([letters[b] for b in x.encode("utf-8", "surrogatepass")]), ranks))
        whole = self.whole
        pieces = lambda x: sum(1 if t in whole else merged[t] for t in PRE_TOKEN.findall(x))
        first = Table({t: 1 for t in whole if t[0] != " "}, pieces)
        spaced = Table({t[1:]: 1 for t in whole if t[0] == " " and len(t) > 1}, lambda x: pieces(" " + x))
        special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

        def plain(text: str) -> int:
            words, gaps = text.split(), text.count(" ") + text.count("\n")
            if len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
                return pieces(text)
            # All white space is single spaces and line ends between words. No pre-token
            # reaches over a line end, or from one word to the next; a space leads its word.
            n = 0
            lines = text.split("\n")
            for line in lines:
                head, *rest = line.split(" ")
                n += first[head] + sum(map(spaced.__getitem__, rest))
            return n + (len(lines) - 1) * first["\n"]

        def count(text: str) -> int:
            if special and any(s in text for s in self.special):
                return len(special.findall(text)) + sum(map(plain, special.split(text)))
            return plain(text)

        return count


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512, keep: list[str] | None = None) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit); null texts count as empty.

    path is the vocabulary file, read once by the driver; tasks get its tables.
    Columns of those names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(Counter(path)))

    def row() -> Callable[[str | None], tuple]:
        tables = shared.value  # one object for all tasks of a worker, which so share what they have counted
        if "count" not in tables:
            made = object.__new__(Counter)
            vars(made).update(tables)
            tables["count"] = made.counter()
        count = tables["count"]

        def one(x: str | None) -> tuple:
            x = x or ""
            n = count(x)
            return len(x.encode("utf-8", "surrogatepass")), n, n > limit

        return one

    return with_columns(docs, text, "n_bytes long, n_tokens long, over_limit boolean", row, keep)
