"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced code point.

The distinct words form a trie. Heavy paths cut it: at every node the child with
most words is heavy, all others, and the end of a word at the node, are light.
Two words part at one node (their longest common prefix), and at least one of
them goes on there by a light child. So the trie's errata at a node come from its
light subtrees alone, each of them merged into the larger one beside it:

* with the parting character skipped, a light subtree's words meet words of the
  node that are one shorter;
* with it replaced by the heavy child's, they meet the heavy subtree's words;
* with the heavy character put before it, heavy words that are one longer;
* with it replaced by a mark, they meet those of other light subtrees.

Words that so end at the same terminal are one edit apart; every near pair is
found once, at the node where it parts. A word lies in at most log2(n) light
subtrees, so n words have at most 4 n (1 + log2 n) errata, and no pairs are tried.

Words are dealt to ranges of their order. A range's task has whole subtries but
for the nodes on the paths of the ranges' edges; the sizes of those nodes'
children are summed over all ranges first. Errata meet words by a join.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, place, written

#: Code points and occurrences that a word has at least, and how much more frequent a form is.
LENGTH, OCCURRENCES, RATIO = 6, 5, 5
#: A document's run is changed where this divides its hash.
CHANGED = 199
#: Words of a range, and the most ranges. A range's edge is at most EDGE code points long.
RANGE, RANGES, EDGE = 40_000, 2000, 256
#: Words drawn for each range to set the edges. They only balance the ranges.
DRAWN = 40
#: Stands for any character in a merged light subtree; no word holds it.
ANY = "\0"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run of letters.
RUN = "([A-Za-zÀ-ÿ]+)"


def counted(docs: DataFrame, text: str = "text", id: str = "doc_id", length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """word and n: the lower-cased runs of letters of all whole texts, each with its number of occurrences.

    A run whose hash with its document's id is a multiple of CHANGED loses one
    code point; runs of documents without id stay as they are. Null texts have none.
    """
    moved, _ = aside(docs)
    rows = moved.select(F.col(f"__{place(docs.columns, id)}").alias("id"), F.explode(F.regexp_extract_all(F.col(f"__{place(docs.columns, text)}"), F.lit(RUN), F.lit(1))).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run"))))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % CHANGED == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.char_length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def common_prefix(a: str, b: str) -> int:
    """How many characters a and b begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def edge_children(words: list[str], low: str | None, high: str | None) -> Counter:
    """How many of a range's words go on by each character at the nodes on the paths of its edges: {(prefix, character): words}.

    An empty character means that a word ends there.
    """
    found: Counter = Counter()
    for w in words:
        for d in range(max([common_prefix(w, e) for e in (low, high) if e is not None], default=-1) + 1):
            found[w[:d], w[d : d + 1]] += 1
    return found


def light_edges(words: list[str], low: str | None, high: str | None, heavy: dict[str, str]) -> Iterator[tuple[int, int, str]]:
    """(i, d, h): words[i] leaves the heavy path at depth d, where the heavy child's character is h.

    words are sorted and are all words of the trie between the edges. heavy has
    the heavy child of every branching node on the edges' paths.
    """
    n = len(words)
    on_edge = [max([common_prefix(w, e) for e in (low, high) if e is not None], default=-1) for w in words]
    for i, w in enumerate(words):
        for d in range(on_edge[i] + 1):
            h = heavy.get(w[:d])
            if h is not None and w[d : d + 1] != h:
                yield i, d, h
    # nodes below: intervals of the sorted words, closed when the next word shares fewer characters
    open_: list[tuple[int, list[int]]] = []  # depth, first words of the children
    for i in range(1, n + 1):
        depth, first = (common_prefix(words[i - 1], words[i]) if i < n else -1), i - 1
        while open_ and open_[-1][0] > depth:
            d, starts = open_.pop()
            first = starts[0]
            if on_edge[first] >= d:
                continue  # a node on an edge's path, seen to above
            ends = [*starts[1:], i]
            # a word that ends at the node comes first and is never heavy beside a child
            sizes = [(e - s) * (len(words[s]) > d) for s, e in zip(starts, ends)]
            k = max(range(len(starts)), key=sizes.__getitem__)
            h = words[starts[k]][d]
            for j, (s, e) in enumerate(zip(starts, ends)):
                if j != k:
                    for x in range(s, e):
                        yield x, d, h
        if i < n:
            if open_ and open_[-1][0] == depth:
                open_[-1][1].append(i)
            else:
                open_.append((depth, [first, i]))


def errata(word: str, d: int, h: str, least: int = LENGTH) -> Iterator[str]:
    """The terminals of a word that leaves the heavy path at depth d, with one character skipped, put before or replaced."""
    head, c, tail = word[:d], word[d : d + 1], word[d + 1 :]
    if c:
        if len(word) > least and tail[:1] != c:  # skipping the last of equal characters is an erratum of a deeper node
            yield head + tail
        yield head + h + tail
        yield head + ANY + tail
    yield head + h + word[d:]


def _edges(words: DataFrame, n: int) -> list[str]:
    """Words that part all words into ranges of about equal size: at most DRAWN * RANGES of them are read for it."""
    ranges = min(RANGES, n // RANGE + 1)
    if ranges == 1:
        return []
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(max(1, n // (ranges * DRAWN)))) == 0).select(F.substring("word", 1, EDGE).alias("word"))
    found = sorted(r.word for r in drawn.collect())
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def all_errata(words: DataFrame, n: int | None = None) -> DataFrame:
    """word, n and key for every erratum of the words' trie; words are distinct."""
    edges = _edges(words, words.count() if n is None else n)
    around = lambda k: (edges[k - 1] if k else None, edges[k] if k < len(edges) else None)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = pa.array([bisect_right(edges, w) for w in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, ranges], names=["word", "n", "range"])

    ranged = words.select("word", "n").mapInArrow(dealt, "word string, n long, range int")

    def children(table: pa.Table) -> pa.Table:
        found = edge_children(table.column("word").to_pylist(), *around(table.column("range")[0].as_py()))
        return pa.table({"prefix": pa.array([p for p, _ in found], pa.string()), "next": pa.array([c for _, c in found], pa.string()), "words": pa.array(found.values(), pa.int64())})

    heavy: dict[str, str] = {}
    if edges:
        sizes = ranged.groupBy("range").applyInArrow(children, "prefix string, next string, words long").groupBy("prefix", "next").agg(F.sum("words").alias("words"))
        # the greater character among equals, so that a word's end is heavy nowhere
        nodes = sizes.groupBy("prefix").agg(F.max(F.struct("words", "next"))["next"].alias("heavy"), F.count(F.lit(1)).alias("children")).where("children > 1")
        # at most EDGE + 1 nodes for each of at most RANGES edges
        heavy = {r.prefix: (r.heavy or "") for r in nodes.collect()}

    def merged(table: pa.Table) -> pa.Table:
        table = table.sort_by("word")
        own, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
        at, keys = [], []
        for i, d, h in light_edges(own, *around(table.column("range")[0].as_py()), heavy):
            made = list(errata(own[i], d, h))
            keys += made
            at += [i] * len(made)
        return pa.table({"word": pa.array([own[i] for i in at], pa.string()), "n": counts[np.array(at, np.int64)], "key": pa.array(keys, pa.string())})

    return ranged.groupBy("range").applyInArrow(merged, "word string, n long, key string")


def near(words: DataFrame, n: int | None = None) -> DataFrame:
    """word, n_near and near (n, word): how many words are one edit away, and the most frequent of them (among equals the smallest)."""
    found = written(all_errata(words, n), "errata")
    marked = F.contains("key", F.lit(ANY))
    one = lambda word, n: F.struct((-n).alias("less"), word.alias("word"))
    # errata that are words: both ends of the pair have one near word more
    met = found.where(~marked).join(words.select(F.col("word").alias("key"), F.col("n").alias("key_n")), "key")
    both = F.array(F.struct(F.col("word"), one(F.col("key"), F.col("key_n")).alias("near")), F.struct(F.col("key").alias("word"), one(F.col("word"), F.col("n")).alias("near")))
    pairs = met.select(F.explode(both).alias("x")).select("x.word", F.lit(1).cast("long").alias("n_near"), "x.near")
    # words of one mark differ in its character alone: no more than there are letters
    light = found.where(marked).groupBy("key").agg(F.sort_array(F.collect_list(one(F.col("word"), F.col("n")))).alias("all")).where(F.size("all") > 1)
    light = light.select("all", F.explode("all").alias("own"))
    light = light.select(F.col("own.word").alias("word"), (F.size("all") - 1).cast("long").alias("n_near"), F.when(F.col("own.word") == F.col("all")[0]["word"], F.col("all")[1]).otherwise(F.col("all")[0]).alias("near"))
    return pairs.unionByName(light).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("near").alias("near"))


def variants(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of all texts (see counted()).

    A word's form is its near word that occurs most, ties to the smaller in
    code-point order, if that is RATIO times as frequent at least; root is where
    forms lead. Null, empty and wordless texts give no words, repeated rows count
    each, very long texts count whole; other columns of docs are not read,
    whatever their names. An empty table gives no rows.
    """
    words = written(counted(docs, text, id), "words")
    n, most = words.agg(F.count(F.lit(1)), F.max("n")).first()
    stats = near(words, n)
    near_n = -F.col("near.less")
    true = near_n >= RATIO * F.col("n")
    found = words.join(stats, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(true, F.col("near.word")).alias("form"), F.when(true, near_n).alias("form_n"))
    found = written(found, "forms")
    # each form is RATIO times as frequent, which bounds the steps to a root; every round doubles those made
    steps = max(1, math.ceil(math.log(max((most or 1) / OCCURRENCES, RATIO), RATIO)))
    linked = found.where("form IS NOT NULL").select("word", "form")
    to = linked
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        to = to.join(to.select(F.col("word").alias("form"), F.col("form").alias("further")), "form", "left").select("word", F.coalesce("further", "form").alias("form"))
    roots = to.select("word", F.col("form").alias("root"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
