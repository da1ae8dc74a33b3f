"""Periodic runs of words: all maximal repetitions, by longest previous factors.

A run is a stretch of words with a smallest period q that no neighbouring word
extends. Each text is a sequence of word numbers. The steps, for many texts at
once where numpy can and text by text where the order matters:

1. Suffix array by doubling: blocks of 1, 2, 4 ... words get names in order, and
   only places whose name is not yet alone are sorted on. The names of all
   lengths are kept: two places' common extension, forwards or backwards, is
   found by descending through them.
2. LCP: the common extension of neighbours in the suffix array. A run as long as
   asked for repeats at least `shared` words one period further on; a text with
   no LCP of that many has no run and is done.
3. LPF: from suffix array and LCP, the longest factor that begins earlier, and
   where; cutting by it gives the LZ blocks.
4. Main's extensions: a run that is not inside a block crosses or touches a
   block's edge. With exponent 3 its period is at most half the sum of the two
   blocks there, so the periods tried add up to the text's length. A period's
   extension to both sides of the edge gives the run.
5. Runs strictly inside a block are copies of earlier ones: runs stand in
   buckets by where they begin, and each block copies its source's, in order.

Time is n log n for n words of a text, memory a few numbers for each word and
doubling. Tasks hold one portion of texts (WORDS), or one longer text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, place, without

#: Words of the texts that are sorted together.
WORDS = 400_000
#: The least words and the least exponent of a run.
LEAST, EXPONENT = 24, 3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Names:
    """The names of the blocks of 1, 2, 4 ... words at all places of several texts laid end to end.

    Equal names mean equal blocks within one text; no name is shared by two texts.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        """words: numbers from 0, equal for equal words; sizes: the texts' lengths."""
        n = len(words)
        text = np.repeat(np.arange(len(sizes)), sizes)
        self.end = np.cumsum(sizes)[text] if n else np.zeros(0, np.int64)
        keys = text * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        fresh = np.append(True, keys[1:] != keys[:-1])[:n]
        name = np.empty(n, np.int32)
        name[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        open_ = order[~(fresh & np.append(fresh[1:], True)[:n])]
        self.levels = [name]
        width = 1
        while len(open_):
            # among places that share a name, order by the name that stands width words on; beyond the text's end is least
            next_ = open_ + width
            second = np.where(next_ < self.end[open_], name[np.minimum(next_, n - 1)], -1)
            at = np.lexsort((second, name[open_]))
            open_ = open_[at]
            first, second = name[open_], second[at]
            starts = np.append(True, first[1:] != first[:-1])
            fresh = starts | np.append(True, second[1:] != second[:-1])
            # a name is the rank of the first place that has it, so names of places that stay alone remain true
            group = np.maximum.accumulate(np.where(starts, np.arange(len(open_)), 0))
            here = np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))
            name = name.copy()
            name[open_] = first + (here - group)
            alone = fresh & np.append(fresh[1:], True)
            open_ = open_[~alone]
            self.levels.append(name)
            width *= 2
        self.array = np.empty(n, np.int64)
        self.array[name] = np.arange(n)

    def forwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are alike from places a and b of one text on; b > a, and b may be its end."""
        found = np.zeros(len(a), np.int64)
        end = self.end[np.minimum(a, max(len(self.end) - 1, 0))] if len(a) else found
        for k in range(len(self.levels) - 1, -1, -1):
            at = np.flatnonzero(b + found + (1 << k) <= end)
            if len(at):
                same = self.levels[k][a[at] + found[at]] == self.levels[k][b[at] + found[at]]
                found[at[same]] += 1 << k
        return found

    def backwards(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """How many words are alike up to and with places a and b, a < b, of a text that begins at start; a may be before it."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            at = np.flatnonzero(a - found - (1 << k) + 1 >= start)
            if len(at):
                same = self.levels[k][a[at] - found[at] - (1 << k) + 1] == self.levels[k][b[at] - found[at] - (1 << k) + 1]
                found[at[same]] += 1 << k
        return found


def previous_factors(array: Sequence[int], lcp: Sequence[int]) -> tuple[list[int], list[int]]:
    """LPF and a place where each factor stands before, from a suffix array and the LCP of each entry with the one before it.

    Entries are taken up and removed by a stack: an entry's nearest neighbours
    that begin earlier in the text are the one below it and the one that removes it.
    """
    n = len(array)
    longest, source = [0] * n, [-1] * n
    stack: list[tuple[int, int]] = []  # places, each with its LCP with the one below
    for i in range(n + 1):
        at, common = (array[i], lcp[i]) if i < n else (-1, 0)
        while stack and stack[-1][0] > at:
            top, below = stack.pop()
            # the neighbour above shares `common` words with top, the one below `below`
            if common >= below and common > 0:
                longest[top], source[top] = common, at
            elif below > 0:
                longest[top], source[top] = below, stack[-1][0]
            common = min(common, below)
        if i < n:
            stack.append((at, common))
    return longest, source


def blocks(longest: Sequence[int]) -> list[int]:
    """Where the LZ blocks begin, and the text's end."""
    edges, at = [0], 0
    while at < len(longest):
        at += max(1, longest[at])
        edges.append(at)
    return edges


def runs(names: Names, first: int, n: int, lcp: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the text of n words that begins at place first, by start and period."""
    # a text's places stand together in the suffix array, as names are in the order of texts
    longest, source = previous_factors((names.array[first : first + n] - first).tolist(), lcp[first : first + n].tolist())
    edges = blocks(longest)
    length = np.diff(edges)
    # at each inner edge and at the end, periods to half of the two blocks' sum
    most = (length + np.append(length[1:], 0)) // 2 + 1
    edge = np.repeat(np.array(edges[1:], np.int64), most)
    period = np.arange(int(most.sum()), dtype=np.int64) - np.repeat(np.cumsum(most) - most, most) + 1
    found: dict[tuple[int, int], int] = {}
    for left, right in ((edge, edge + period), (edge - period, edge)):
        fits = (left >= 0) & (right <= n)
        a, b, p = left[fits] + first, right[fits] + first, period[fits]
        # a period that neither side of the edge keeps for one word cannot make a run
        word, last = names.levels[0], first + n - 1
        near = ((b <= last) & (word[a] == word[np.minimum(b, last)])) | ((a > first) & (word[np.maximum(a - 1, first)] == word[b - 1]))
        a, b, p = a[near], b[near], p[near]
        after, before = names.forwards(a, b), names.backwards(a - 1, b - 1, np.full(len(a), first))
        size = before + after + p
        good = (size >= least) & (size >= exponent * p)
        for s, z, q in zip((a - before - first)[good].tolist(), size[good].tolist(), p[good].tolist()):
            if q < found.get((s, z), n + 1):
                found[s, z] = q
    return sorted((s, z, q) for (s, z), q in _with_copies(found, edges, source).items())


def _with_copies(found: dict[tuple[int, int], int], edges: list[int], source: Sequence[int]) -> dict[tuple[int, int], int]:
    """The runs with those that stand inside blocks, copied from the blocks' sources."""
    if not found:
        return found
    bucket: dict[int, list[tuple[int, int]]] = {}
    for s, z in found:
        bucket.setdefault(s, []).append((z, found[s, z]))
    starts = sorted(bucket)
    for begin, end in zip(edges[:-1], edges[1:]):
        old = source[begin]
        if old < 0 or end - begin < 3:
            continue
        shift = begin - old
        i = bisect_right(starts, old)
        while i < len(starts) and starts[i] < end - shift - 1:
            s = starts[i]
            for z, q in bucket[s]:
                # strictly inside the source, so that the words on both sides are copied as well
                if s + z < end - shift and (s + shift, z) not in found:
                    found[s + shift, z] = q
                    if s + shift not in bucket:
                        bucket[s + shift] = []
                        starts.insert(bisect_right(starts, s + shift), s + shift)
                    bucket[s + shift].append((z, q))
            i += 1
    return found


def all_runs(texts: Sequence[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; texts are arrays of word numbers. exponent is 3 at least."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64)
    if not len(words):
        return [[] for _ in texts]
    names = Names(words, sizes)
    pairs = names.array
    a, b = np.minimum(pairs[:-1], pairs[1:]), np.maximum(pairs[:-1], pairs[1:])
    lcp = np.zeros(len(words), np.int64)
    # places of different texts share no name, not even of one word
    alike = np.flatnonzero(names.levels[0][a] == names.levels[0][b])
    lcp[alike + 1] = names.forwards(a[alike], b[alike])
    first = np.cumsum(sizes) - sizes
    # a run of z words with period q has the same z - q words one period on
    shared = least - least // exponent
    highest = np.zeros(len(texts), np.int64)
    full = np.flatnonzero(sizes)
    highest[full] = np.maximum.reduceat(lcp, first[full])
    return [runs(names, int(f), int(n), lcp, least, exponent) if h >= shared else [] for f, n, h in zip(first, sizes, highest)]


def rewritten(words: list[str], doc_id: int | None) -> list[str]:
    """The words, in a tenth of the documents (by their id) made periodic from some word on; documents without id stay as they are."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[: n - a]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def best(found: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, then the smallest start and period."""
    top = None
    for s, z, q in found:
        if top is None or z * top[2] > top[1] * q or (z * top[2] == top[1] * q and (s, q) < (top[0], top[2])):
            top = (s, z, q)
    return top


def kept(words: list[str], found: Sequence[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for s, z, q in found:
        edge[s + q] += 1
        edge[s + z] -= 1
    gone = np.cumsum(edge)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


#: What with_runs() adds: runs as structs, the best run, the text without what repeats.
ADDED = "runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, n_words long, collapsed string"


def with_runs(docs: DataFrame, text: str = "text", id: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) and ADDED.

    Words are what stands between ASCII white space. Null, empty and blank texts
    have no words and no runs. Rows stand for themselves: repeated rows have the
    same runs. Very long texts are sorted alone. Columns of docs named like
    those of ADDED are replaced, no other name clashes. An empty table gives an
    empty result. With id, words are first rewritten() by that column.
    """
    made = T._parse_datatype_string(ADDED)
    columns = without(docs.columns if keep is None else keep, [f.name for f in made.fields])
    at = [place(docs.columns, c) for c in columns]
    schema = T.StructType([T.StructField(c, docs.schema.fields[i].dataType, docs.schema.fields[i].nullable) for c, i in zip(columns, at)] + made.fields)
    moved, _ = aside(docs)
    own = F.col(f"__{place(docs.columns, id)}") if id else F.lit(None).cast("long")
    rows = moved.select(*(F.col(f"__{i}").alias(f"c{k}") for k, i in enumerate(at)), own.alias("id"), F.col(f"__{place(docs.columns, text)}").alias("text"))

    def numbered(words: list[str], index: dict[str, int]) -> np.ndarray:
        return np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))

    def portion(words: list[list[str]]) -> list[tuple]:
        index: dict[str, int] = {}
        out = []
        for w, found in zip(words, all_runs([numbered(x, index) for x in words])):
            out.append(([dict(zip(("start", "length", "period"), r)) for r in found], dict(zip(("start", "length", "period"), best(found))) if found else None, len(w), " ".join(kept(w, found))))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def flushed(part: pa.RecordBatch, words: list[list[str]]) -> pa.RecordBatch:
            values = portion(words)
            arrays = [part.column(i).cast(f.type) for i, f in zip(range(len(at)), arrow)]
            arrays += [pa.array([v[i] for v in values], arrow.field(len(at) + i).type) for i in range(4)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            start, held, size = 0, [], 0
            for i in range(batch.num_rows):
                words = rewritten(_WORD.findall(batch.column(len(at) + 1)[i].as_py() or ""), batch.column(len(at))[i].as_py() if id else None)
                if held and size + len(words) > WORDS:
                    yield flushed(batch.slice(start, len(held)), held)
                    start, held, size = i, [], 0
                held.append(words)
                size += len(words)
            if held:
                yield flushed(batch.slice(start, len(held)), held)

    return rows.mapInArrow(work, schema)


def digest(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the best run and hashes of all runs and of the collapsed text."""
    found = with_runs(docs, text, id, keep=[id])
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        id, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
