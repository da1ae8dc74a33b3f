"""BPE encoding and decoding by a table of distinct words.

1. Each task cuts its texts into blocks of bounded size, lists a block's
   distinct words and writes every text as positions in that list.
2. The lists are shuffled by a hash of the word, so equal words of all blocks
   meet. Lists stream past a table of the words met so far: a word is encoded
   when it is first met. The table is bounded (WORDS); where a bucket has more
   distinct words than that, it begins anew, and a word may be encoded again.
3. The ids go back to their blocks, a folder for each of the input's partitions.
   The task that reads a block's texts joins them to its ids by position.
4. Decoding joins ids to the vocabulary's pieces: a map-side join with a table
   of the vocabulary's size, done by Arrow's take.

Words are split in the tasks that read the texts, on Spark's partitions. A word
is a run without ASCII white space; that is exact for vocabularies whose
pre-tokens never hold white space, and others are refused. Texts themselves are never shuffled. Lists
and positions are written compressed, a row for each block and hash bucket, so
what is written and shuffled stays near the input's size. No row, table or block
grows with the corpus; tasks hold one block or one bounded table.

Null, empty and blank texts have no ids and decode to an empty text. Rows that
are alike are encoded alike, each for itself. Very long texts are blocks of
their own. Other columns, whatever their names, are left alone, but one named
like the output is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, new_folder, placed, store_of, without, written

#: Characters of a block's texts, distinct words that a task holds with their ids, and words that are encoded at once.
BLOCK_CHARS, WORDS, ENCODE_AT_ONCE = 32_000_000, 300_000, 10_000
#: Ids and rows that are put together and decoded at once; a longer text is alone.
IDS_AT_ONCE, ROWS_AT_ONCE = 1_000_000, 200


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _expand(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32 by byte planes: the upper planes are mostly zero."""
    return _squeeze(np.ascontiguousarray(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(_expand(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").reshape(-1)


class _Block:
    """The texts of a block as positions in its list of distinct words."""

    def __init__(self, buckets: int):
        self.buckets, self.size = buckets, 0
        self.index: dict[bytes, int] = {}
        self.rows: list[dict] = []
        self.found: list[np.ndarray] = []

    def add(self, row: dict, text: str) -> None:
        words, index = text.encode("utf-8", "surrogatepass").split(), self.index
        for w in words:
            if w not in index:
                index[w] = len(index)
        self.found.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
        self.rows.append(row)
        self.size += len(text)

    def out(self, block: int) -> Iterator[dict]:
        """A row for each bucket that has words, then one for each text.

        A word's place is its rank among its bucket's words, most frequent
        first, times the number of buckets, plus the bucket: frequent words have
        small places, which pack well.
        """
        words = list(self.index)
        count = np.zeros(len(words), np.int64)
        for at in self.found:
            np.add.at(count, at, 1)
        bucket = np.fromiter((zlib.crc32(w) % self.buckets for w in words), np.int64, len(words))
        order = np.lexsort((-count, bucket))
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        place = np.empty(len(words), np.uint32)
        place[order] = (np.arange(len(words)) - edges[bucket[order]]) * self.buckets + bucket[order]
        for b in np.flatnonzero(edges[1:] > edges[:-1]):
            yield {"__block": block, "__bucket": int(b), "__words": _squeeze(b" ".join([words[i] for i in order[edges[b] : edges[b + 1]]]))}
        for row, at in zip(self.rows, self.found):
            yield row | {"__block": block, "__bucket": self.buckets, "__places": _pack(place[at])}


def _blocks(schema: pa.Schema, buckets: int, limit: int):
    def batches_of(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in rows:
            held.append(row)
            if len(held) == 500:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number, block = TaskContext.get().partitionId(), 0, _Block(buckets)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for row in batch.slice(at, 200).to_pylist():
                    text = row.pop("__text") or ""
                    if block.rows and block.size + len(text) > limit:
                        yield from batches_of(block.out((partition << 24) + number))
                        number, block = number + 1, _Block(buckets)
                    block.add(row, text)
        if block.rows:
            yield from batches_of(block.out((partition << 24) + number))

    return run


def _load(made: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(made)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Table:
    """The ids of the words met so far, one after another, and where each word's stand."""

    def __init__(self, tokenizer, limit: int):
        self.tokenizer, self.limit = tokenizer, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.start, self.count, self.flat = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint32)]

    def places(self, words: list[bytes]) -> np.ndarray:
        """Where the words stand; those that are new are encoded and added."""
        if len(self.index) + len(words) > self.limit:
            self.clear()
        index = self.index
        new = [w for w in dict.fromkeys(words) if w not in index]
        index.update(zip(new, range(len(index), len(index) + len(new))))
        for at in range(0, len(new), ENCODE_AT_ONCE):
            texts = [w.decode("utf-8", "surrogatepass") for w in new[at : at + ENCODE_AT_ONCE]]
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))])
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each place has, and the ids."""
        return self.count[places], self.flat[_runs(self.start[places], self.count[places])]


def _encoder(made, limit: int):
    """Lists of a partition, sorted by bucket: each comes back as its words' numbers of ids and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bucket = None, None
        for batch in batches:
            at = 0
            for upto in _slices(batch.column("__words"), 4 << 20):
                part, rows = batch.slice(at, upto - at), []
                at = upto
                table = table or _Table(_load(made.value), limit)
                buckets = part.column("__bucket").to_pylist()
                lists = [_expand(x).split(b" ") for x in part.column("__words").to_pylist()]
                k = 0
                while k < len(lists):  # lists of one bucket are looked up together, as far as the table goes
                    if buckets[k] != bucket:
                        bucket = buckets[k]
                        table.clear()
                    end, held = k + 1, len(lists[k])
                    while end < len(lists) and buckets[end] == bucket and held + len(lists[end]) <= limit // 2:
                        held += len(lists[end])
                        end += 1
                    places = table.places([w for words in lists[k:end] for w in words])
                    edges = np.cumsum([len(words) for words in lists[k:end]])[:-1]
                    for mine in np.split(places, edges):
                        counts, ids = table.of(mine)
                        rows.append((_pack(counts), _pack(ids)))
                    k = end
                yield pa.RecordBatch.from_arrays([part.column("__block"), part.column("__bucket"), *(pa.array(x, pa.binary()) for x in zip(*rows))], names=["__block", "__bucket", "__counts", "__ids"])

    return run


def _slices(column: pa.Array, size: int) -> Iterator[int]:
    """Ends of runs of rows with about size bytes."""
    total, n = 0, len(column)
    for i in range(n):
        total += len(column[i].as_buffer() or b"") if column[i].is_valid else 0
        if total >= size or i == n - 1:
            yield i + 1
            total = 0


def _even(lists: pa.Array) -> Iterator[int]:
    """Ends of runs of rows with at most IDS_AT_ONCE list items and ROWS_AT_ONCE rows, one row at least."""
    import pyarrow.compute as pc

    start, size, lengths = 0, 0, pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and (size + n > IDS_AT_ONCE or i - start == ROWS_AT_ONCE):
            yield i
            start, size = i, 0
        size += n
    if lengths:
        yield len(lengths)


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] of them, and so on for all runs."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - count), count)


class _Ids:
    """The ids of a block's words by place."""

    def __init__(self, folder: str, block: int, buckets: int):
        from pyarrow import dataset, fs

        store, path = store_of(f"{folder}/__part={block >> 24}")
        self.start = self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return  # no text of the block has a word
        rows = dataset.dataset(path, filesystem=store, format="parquet").to_table(columns=["__bucket", "__counts", "__ids"], filter=dataset.field("__block") == block)
        if not rows.num_rows:
            return
        bucket = rows.column("__bucket").to_pylist()
        counts = [_unpack(x).astype(np.int64) for x in rows.column("__counts").to_pylist()]
        self.flat = np.concatenate([_unpack(x) for x in rows.column("__ids").to_pylist()])
        size = max(map(len, counts)) * buckets
        self.start, self.count, at = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
        for b, c in zip(bucket, counts):
            place = np.arange(len(c)) * buckets + b
            self.count[place], self.start[place] = c, at + np.cumsum(c) - c
            at += int(c.sum())

    def of(self, places: np.ndarray) -> np.ndarray:
        return self.flat[_runs(self.start[places], self.count[places])]


def _texts_of(ids: pa.Array, piece: pa.Array) -> pa.Array:
    """The ids of each row joined to their pieces: a text; null for null."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, piece.take(ids.flatten())), " ")
    return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)


def _assembler(kept: int, schema: pa.Schema, folder: str, buckets: int, shared):
    """Texts of a partition, block after block, with the ids of their words; the first `kept` columns go along."""

    def together(part: pa.RecordBatch, made: list[np.ndarray], piece: pa.Array | None) -> pa.RecordBatch:
        edges = np.cumsum([0, *map(len, made)])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(made)))
        out = [part.column(i).cast(schema.field(i).type) for i in range(kept)] + [lists.cast(schema.field(kept).type)]
        return pa.RecordBatch.from_arrays(out + ([_texts_of(lists, piece)] if piece else []), schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids = None, None
        piece = shared and pa.array(shared.value, pa.string())
        for batch in batches:
            start, made, size = 0, [], 0
            for i in range(batch.num_rows):
                b = batch.column("__block")[i].as_py()
                if b != block:
                    block, ids = b, None  # the last block's ids go before the next ones come
                    ids = _Ids(folder, b, buckets)
                # packed places say nothing of their number: repetitive texts pack to very little
                own = ids.of(_unpack(batch.column("__places")[i].as_py())).astype(np.int32)
                if made and (size + len(own) > IDS_AT_ONCE or len(made) == ROWS_AT_ONCE):
                    yield together(batch.slice(start, len(made)), made, piece)
                    start, made, size = i, [], 0
                made.append(own)
                size += len(own)
            if made:
                yield together(batch.slice(start, len(made)), made, piece)

    return run


def checked(made: str, path: str) -> str:
    """A tokenizer's file, if it encodes words parted by ASCII white space each for itself; an error for others."""
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer, said = _load(made), ("word", "Word", "it's", "'s", "12", "--", "a1", "é", "漢", "#")
    alone = {w: ids(w) for w in said}
    parted = all(ids(f"{a}{s}{b}") == alone[a] + alone[b] for a in said for b in said for s in (" ", "\t", "\n", "\x0b", "\x0c", "\r", " \n "))
    if not parted or ids(" ") or ids("\n"):
        raise ValueError(f"{path}: its pre-tokens hold white space, so words cannot be encoded each for itself")
    return made


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, block_chars: int = BLOCK_CHARS, decoded: str | None = None) -> DataFrame:
    """docs' columns (or those in keep) and ids, an array of the text's token ids.

    With decoded, a column of that name has what decode() makes of the ids,
    joined in the task that has them.

    path is a tokenizers JSON file that the driver reads. Null texts count as
    empty and have an empty array. The text column itself is not carried along
    unless keep names it; a column ids is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kept = without(docs.columns if keep is None else keep, [*(["ids"] if keep is not None else ["ids", text]), *([decoded] if decoded else [])])
    moved, _ = aside(docs)
    fields = [T.StructField(f"c{i}", moved.schema[placed(docs, c)].dataType, True) for i, c in enumerate(kept)]
    with open(path, encoding="utf-8") as f:
        made = spark.sparkContext.broadcast(checked(f.read(), path))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [T.StructField("__block", T.LongType()), T.StructField("__bucket", T.IntegerType()), T.StructField("__words", T.BinaryType()), T.StructField("__places", T.BinaryType())]
    schema = T.StructType(fields + own)
    source = moved.select(*(F.col(placed(docs, c)).alias(f"c{i}") for i, c in enumerate(kept)), F.col(placed(docs, text)).alias("__text"))
    blocks = written(source.mapInArrow(_blocks(to_arrow_schema(schema), buckets, block_chars), schema), "word-blocks")
    words = blocks.where("__words IS NOT NULL").select("__block", "__bucket", "__words")
    encoded = words.repartition("__bucket").sortWithinPartitions("__bucket").mapInArrow(_encoder(made, WORDS), "__block long, __bucket int, __counts binary, __ids binary")
    folder = new_folder(spark, "block-ids")
    part = F.shiftright("__block", 24).alias("__part")
    # sorted by block in row groups of some MB: who reads a block's ids skips the others of its folder
    encoded.select("*", part).repartition("__part").sortWithinPartitions("__part", "__block").write.option("parquet.block.size", 4 << 20).partitionBy("__part").parquet(folder)
    texts = blocks.where("__places IS NOT NULL").select(*(f.name for f in fields), "__block", "__places")
    out = T.StructType([T.StructField(c, f.dataType) for c, f in zip(kept, fields)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else []))
    shared = spark.sparkContext.broadcast(_spaced_pieces(path)) if decoded else None
    return texts.mapInArrow(_assembler(len(kept), to_arrow_schema(out), folder, buckets, shared), out)


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces by id, added tokens included; its size does not depend on the corpus."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    by_id = {i: p for p, i in made["model"]["vocab"].items()} | {t["id"]: t["content"] for t in made["added_tokens"]}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]


def _spaced_pieces(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        if json.load(f).get("decoder"):
            raise ValueError("only vocabularies without a decoder join their pieces by spaces")
    return pieces(path)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded and the column out: the pieces of its ids joined by spaces, as a vocabulary without a decoder has it.

    Null ids give null, no ids an empty text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = encoded.sparkSession.sparkContext.broadcast(_spaced_pieces(path))
    kept = without(encoded.columns, [out])
    place = kept.index(ids)
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, piece = to_arrow_schema(schema), pa.array(shared.value, pa.string())
        for batch in batches:
            at = 0
            for upto in _even(batch.column(place)):
                part, at = batch.slice(at, upto - at), upto
                texts = _texts_of(part.column(place), piece)
                yield pa.RecordBatch.from_arrays([*(part.column(i).cast(arrow.field(i).type) for i in range(len(kept))), texts], schema=arrow)

    return encoded.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)
