"""Token ids of documents as ORC files, in ascending order of the documents' ids.

Documents are dealt to ranges of doc_id and sorted there; each range is encoded
by the task that has it and written as one ORC file. Ids are integers, which ORC
stores by run lengths in stripes; a row index with least and greatest values and
a Bloom filter on doc_id let a reader skip stripes and groups of rows, and the
stripes of a file can be read by several tasks. A row holds, besides its ids,
the number of its file and of the ids before it in that file, so places in the
whole sequence need only one sum a file.

Only the texts are shuffled, and no ids. A range is as large as Spark's shuffle
partitions are; equal doc_ids are split by a hash of the text and then by where
rows were read, so that a hot one fills no task.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, new_folder, place
from .token_counts import PRE_TOKEN

#: Units whose ids a task holds, and characters that are encoded at once.
UNITS, CHARS = 1_500_000, 4_000_000
#: How files are laid out: bytes of a stripe, rows of an index entry, the Bloom filter's share of false finds.
LAYOUT = {"compression": "zstd", "orc.stripe.size": str(32 << 20), "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


class _Places(dict):
    """Units and their places; one that is asked for first gets the next place and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = at = len(self)
        self.new.append(unit)
        return at


class Encoder:
    """Encodes texts by units: each distinct unit is encoded once by the library and its ids kept.

    A unit is what no pre-token of the byte-level pattern reaches out of. In
    texts whose words are parted by single spaces and line ends, units are words
    with what parts them from the word before; in others, pre-tokens. Texts with
    the string of a special token are encoded whole. The first limit units are
    kept; those met later are encoded again with each portion that has them.
    """

    def __init__(self, made: str, limit: int = UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(made)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in json.loads(made)["added_tokens"]]
        self.limit, self.places = limit, _Places()
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.line = self._ids("\n")

    def _ids(self, text: str) -> np.ndarray:
        # the batch form leaves offsets out, which are not needed
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    @staticmethod
    def marked(text: str) -> str | None:
        """text with its units' keys parted by spaces; None where white space is not single spaces and line ends between words.

        A key is a mark for what stands before the word (\\0 a line end, \\1 nothing, none: a space), and the word.
        """
        words, gaps = text.split(), text.count(" ") + text.count("\n")
        if len(words) == gaps + 1 and sum(map(len, words)) + gaps == len(text) and "\0" not in text and "\1" not in text:
            return ("\1" + text).replace("\n", " \0")
        return None

    def _numbered(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The places of all texts' units and how many each has. Arrow finds a portion's distinct units before they are looked up."""
        marked = list(map(self.marked, texts))
        known = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        distinct = known.values.dictionary_encode()
        places = np.fromiter(map(self.places.__getitem__, distinct.dictionary.to_pylist()), np.int64, len(distinct.dictionary))
        at, edges = places[distinct.indices.to_numpy()], known.offsets.to_numpy()
        if all(marked):
            return at, np.diff(edges)
        parts = [at[edges[i] : edges[i + 1]] if m else np.array([self.places["\1" + p] for p in PRE_TOKEN.findall(texts[i])], np.int64) for i, m in enumerate(marked)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, none of which has a line end, and how many each has.

        They are joined by line ends, encoded as one and parted at the line end's id.
        """
        if len(self.line) == 1:
            ids = self._ids("\n".join(texts))
            ends = np.append(np.flatnonzero(ids == self.line[0]), len(ids))
            if len(ends) == len(texts):
                return ids[ids != self.line[0]], np.diff(ends, prepend=-1) - 1
        return self._one_by_one(texts)

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, new: list[str]) -> None:
        """Add the ids of units that have just got places."""
        first = len(self.start)
        kinds: dict[str, list[int]] = {"spaced": [], "plain": [], "line": [], "odd": []}
        for i, u in enumerate(new):
            kinds["line" if u[0] == "\0" else "spaced" if u[0] != "\1" else "plain" if u[1:].split() == [u[1:]] else "odd"].append(i)
        count, start, flat, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), [self.flat], len(self.flat)
        for kind, at in kinds.items():
            if not at:
                continue
            texts = [" " + new[i] if kind == "spaced" else new[i][1:] for i in at]
            ids, n = self._one_by_one(texts) if kind == "odd" else self._encoded(texts)
            if kind == "line":  # the line end's own ids before each word's
                ids, n = np.insert(ids, np.repeat(np.cumsum(n) - n, len(self.line)), np.tile(self.line, len(n))), n + len(self.line)
            count[at], start[at] = n, size + np.cumsum(n) - n
            flat.append(ids)
            size += len(ids)
        self.start, self.count, self.flat = np.concatenate([self.start, start]), np.concatenate([self.count, count]), np.concatenate(flat)
        assert len(self.start) == first + len(new) == len(self.places)

    def _forget(self, new: list[str]) -> None:
        """Drop the places beyond the limit, which are all among the new ones."""
        for u in new[self.limit - len(self.places) :]:
            del self.places[u]
        self.start, self.count = self.start[: self.limit], self.count[: self.limit]
        # ids of one portion lie by kind, so those kept are copied together anew
        ends = np.cumsum(self.count)
        self.flat = self.flat[np.repeat(self.start - (ends - self.count), self.count) + np.arange(int(self.count.sum()))]
        self.start = ends - self.count

    def __call__(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the edges of each one's."""
        whole = {i for s in self.special for i, t in enumerate(texts) if s in t}
        at, sizes = self._numbered(["" if i in whole else t for i, t in enumerate(texts)])
        new, self.places.new = self.places.new, []
        if new:
            self._learn(new)
        count = self.count[at]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.start[at] - (ends - count), count) + np.arange(int(count.sum()))]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        if len(self.places) > self.limit:
            self._forget(new)
        if whole:
            parts = [self._ids(t) if i in whole else ids[edges[i] : edges[i + 1]] for i, t in enumerate(texts)]
            ids, edges = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, edges


def _portions(texts: Iterable[str], limit: int) -> Iterator[tuple[int, list[str]]]:
    """Texts in order, as many as have limit characters, with the place of the first."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id: str = "doc_id", text: str = "text") -> "TokenFiles":
    """Encode every whole text and write its ids, end_id after each document, in ascending order of id.

    Null texts count as empty and have end_id only. Rows without id come first.
    Rows of one id stand by their texts' hash; equal rows are kept each. Very
    long texts are portions of their own. No other column of docs is read,
    whatever its name. An empty table gives no rows. vocabulary is the path of a
    byte-level tokenizer, read by the driver.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast({"made": f.read()})  # as large as the vocabulary file
    folder = folder or new_folder(spark, "token-ids")
    moved, _ = aside(docs)
    rows = moved.select(F.col(f"__{place(docs.columns, id)}").alias("doc_id"), F.col(f"__{place(docs.columns, text)}").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "read_at": F.monotonically_increasing_id()})
    keys = ["doc_id", "tie", "read_at"]
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string("file long, before long, n_tokens long, ids array<int>").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, file, before, held = to_arrow_schema(schema), TaskContext.get().partitionId(), 0, shared.value
        if "encoder" not in held:  # one for all tasks of a worker, which so share what they have met
            held["encoder"] = Encoder(held["made"])
        encoder = held["encoder"]
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                for start, texts in _portions((x or "" for x in part.column(1).to_pylist()), CHARS):
                    ids, edges = encoder(texts)
                    flat, edges = np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))
                    arrays = [part.column(0).slice(start, len(texts)), pa.array(np.full(len(texts), file)), pa.array(before + edges[:-1]), pa.array(np.diff(edges)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))]
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow)], schema=arrow)
                    before += int(edges[-1])

    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text").mapInArrow(encode, schema).write.options(**LAYOUT).orc(folder)
    return TokenFiles(spark, folder, schema)


class TokenFiles:
    """Written ids. Reading them needs the folder alone."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | None = None):
        self.spark, self.folder = spark, folder
        self.rows = (spark.read.schema(schema) if schema else spark.read).orc(folder)

    def files(self) -> DataFrame:
        """A row for each file: its number, its ids and those of all files before it. Reads two narrow columns."""
        sums = self.rows.groupBy("file").agg(F.max(F.col("before") + F.col("n_tokens")).alias("tokens"))
        # one row a file: their number is that of shuffle partitions, not of documents
        return sums.withColumn("base", F.coalesce(F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def documents(self, doc_ids: Sequence | None = None) -> DataFrame:
        """doc_id, start (ids of all documents before), n_tokens and ids; of the doc_ids given, or of all.

        doc_ids are pushed to the files: stripes and groups of rows whose ranges
        or Bloom filters hold none of them are not read.
        """
        rows = self.rows if doc_ids is None else self.rows.where(F.col("doc_id").isin(list(doc_ids)))
        # a row for each file: as many as the writing job had shuffle partitions, whatever the corpus
        return rows.join(F.broadcast(self.files().select("file", "base")), "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")

    def slice(self, start: int, stop: int) -> DataFrame:
        """The documents with ids in [start, stop) of the whole sequence."""
        found = self.documents()
        return found.where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))

    def digest(self) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32, the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
        found = self.documents()
        schema = T.StructType([found.schema["doc_id"], *T._parse_datatype_string("start long, n_tokens long, ids_crc32 long").fields])

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            for batch in batches:
                ids = batch.column(3)
                flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
                edges = ids.offsets.to_numpy()
                crc = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.int64())
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns[:3], crc], arrow)], schema=arrow)

        return found.mapInArrow(sums, schema)
