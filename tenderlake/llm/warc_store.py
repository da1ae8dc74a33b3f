"""WARC archives with a two-level capture index.

Records are written as gzip members, one file a task, into a shared folder.
A task's captures are returned through Spark, and only files that they name
count, so repeated tasks do no harm. The captures, sorted by reversed-host URL
key, become compressed blocks of lines; a sparse directory keeps each block's
first key and place. Where the directory itself outgrows what a task may hold,
it is sorted into blocks in the same way, with a sparser directory above it.

Keys are looked up by the batch in Spark tasks: each is bisected in the sparse
directory, the blocks that may hold it are dealt out, a block is read by range
once and bisected for the keys that are asked of it, and then the records are
read by range. A key with captures in many blocks is dealt to many tasks.

Html never goes through a shuffle: roles follow from a light table of digests.
Null html is an empty payload, null and unparsable URLs have keys of their own,
rows that are alike are records of their own, an empty table makes an empty
archive, and other columns of pages do not matter.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, store_of, written

BLOCK_LINES = 3000
#: The longest directory that a task holds, about 100 MB; a longer one gets a directory of its own above it.
DIRECTORY_ROWS = 500_000
#: Digests of repeated payloads that are sent to all tasks, about 50 MB; beyond that they are joined by shuffles.
REPEATED_ROWS = 500_000
#: Bytes of payloads that a batch of records holds.
BATCH_BYTES = 8 << 20
LEAST_REVISIT = 1000
READ_AHEAD = 4 << 20


def url_key(url: str | None) -> str:
    """The URL with its host reversed and without its scheme and fragment: http://a.b.org/x -> org,b,a)/x"""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return f"){url}"
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record: a response, or a revisit of the page refers_to without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers (lower-case names) and its block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    return headers, rest[: int(headers["content-length"])]


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").rstrip(">")
    return int(digits) if digits else None


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html (never null) with digest and refers_to, the page that a revisit has its payload from.

    Of equal payloads of LEAST_REVISIT bytes or more, that of the largest
    page_id is the response. Only payloads that occur more than once matter: a
    table of their digests, made from light rows, stands beside the pages. Where
    it is too large for that, pages are joined with it by digest, a frequent
    one spread by page_id.
    """
    html = F.coalesce("html", F.lit(""))
    long = F.octet_length(html) >= LEAST_REVISIT
    digest = F.sha1(F.encode(html, "UTF-8")).alias("digest")
    light = pages.where(long).select("page_id", digest)
    first = light.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    first = written(first, "repeated-payloads")
    own = pages.select("page_id", "url", html.alias("html"), digest)
    if first.count() <= REPEATED_ROWS:
        both = own.join(F.broadcast(first), "digest", "left")
    else:
        spread = 64
        salt = F.pmod(F.xxhash64("page_id"), F.lit(spread)).alias("salt")
        both = own.select("*", salt).join(first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))).alias("salt")), ["digest", "salt"], "left")
    refers = F.when((F.octet_length("html") >= LEAST_REVISIT) & (F.col("page_id") != F.col("first")), F.col("first"))
    return both.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write what with_roles() returns; a row a record: key, page_id, file, offset, length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        store.create_dir(path)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                rows: tuple[list, ...] = ([], [], [], [], [])
                for start in range(0, batch.num_rows, 200):
                    for r in batch.slice(start, 200).to_pylist():
                        out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                        member = gzip.compress(record(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["digest"], r["refers_to"]), 3, mtime=0)
                        out.write(member)
                        for column, value in zip(rows, (_plain(url_key(r["url"])), r["page_id"], name, at, len(member))):
                            column.append(value)
                        at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())], names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out:
                out.close()

    return pages.mapInArrow(run, "key string, page_id long, file string, offset long, length long")


def write_blocks(rows: DataFrame, folder: str, lines: int | None = None) -> DataFrame:
    """Write rows sorted by key as compressed blocks; their directory: key (a block's first), shard, offset, length, lines.

    A line is the key and the row's other columns.
    """
    lines, others = lines or BLOCK_LINES, [c for c in rows.columns if c != "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        store.create_dir(path)
        shard, at, out, block, made = f"{uuid.uuid4().hex}.gz", 0, None, [], []

        def flush() -> None:
            nonlocal at, out
            out = out or store.open_output_stream(f"{path}/{shard}", compression=None)
            member = gzip.compress("".join(f"{k} {json.dumps(v)}\n" for k, v in block).encode("utf-8", "surrogatepass"), 6, mtime=0)
            out.write(member)
            made.append((block[0][0], shard, at, len(member), len(block)))
            at += len(member)
            block.clear()

        def batch_of() -> pa.RecordBatch:
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*made) if made else [[]] * 5, types)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, names=["key", "shard", "offset", "length", "lines"])

        try:
            for batch in batches:
                keys = batch.column("key").to_pylist()
                for k, *v in zip(keys, *(batch.column(c).to_pylist() for c in others)):
                    block.append((k, v))
                    if len(block) == lines:
                        flush()
                if len(made) >= 10_000:
                    yield batch_of()
            if block:
                flush()
        finally:
            if out:
                out.close()
        yield batch_of()

    ordered = rows.repartitionByRange("key", *others[1:3]).sortWithinPartitions("key", *others)
    return ordered.mapInArrow(run, "key string, shard string, offset long, length long, lines long")


def _plain(key: str) -> str:
    """Keys stand before the first space of a line."""
    return key.replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D")


def _lines(member: bytes) -> Iterable[tuple[str, list]]:
    for line in gzip.decompress(member).decode("utf-8", "surrogatepass").split("\n")[:-1]:
        key, _, value = line.partition(" ")
        yield key, json.loads(value)


def blocks_with(keys: DataFrame, sparse: list[tuple]) -> DataFrame:
    """key, shard, offset, length: the blocks that may hold each of the keys, by bisecting a sorted sparse directory."""
    shared = keys.sparkSession.sparkContext.broadcast(sparse)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        first = [e[0] for e in entries]
        for batch in batches:
            held: list[tuple] = []
            for key in batch.column("key").to_pylist():
                # the key's lines may begin in the last block that begins before it, and go on while blocks begin with it
                at = max(0, bisect_left(first, key) - 1)
                for e in entries[at : bisect_right(first, key)]:
                    held.append((key, *e[1:4]))
                    if len(held) == 10_000:
                        yield _columns(held, _PLACES)
                        held = []
            yield _columns(held, _PLACES)

    return keys.mapInArrow(run, "key string, shard string, offset long, length long")


def lines_with(asked: DataFrame, folder: str, out: str) -> DataFrame:
    """The lines of blocks that have the keys asked of them: what blocks_with() returns in, key and the DDL columns out."""
    fields = [("key", pa.string()), *((c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in out.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        place, f, keys, values = None, None, [], []
        for batch in batches:
            held: list[tuple] = []
            for key, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "shard", "offset", "length"))):
                if (shard, offset) != place:
                    if f is None or shard != place[0]:
                        if f:
                            f.close()
                        f = store.open_input_file(f"{path}/{shard}")
                    place = shard, offset
                    f.seek(offset)
                    keys, values = [list(x) for x in zip(*_lines(f.read(length)))]
                for v in values[bisect_left(keys, key) : bisect_right(keys, key)]:
                    held.append((key, *v))
            yield _columns(held, fields)
        if f:
            f.close()

    dealt = asked.repartition("shard", "offset").sortWithinPartitions("shard", "offset", "key")
    return dealt.mapInArrow(run, f"key string, {out}")


_PLACES = [("key", pa.string()), ("shard", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]


def _columns(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def read_records(captures: DataFrame, folder: str, html: bool = True) -> DataFrame:
    """The records at the captures' places: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, html (null for revisits).

    Places are read in the order of files, neighbours by one read. Batches are
    bounded by the bytes of their payloads. A response whose payload does not
    have its digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        name, f, start, held = None, None, 0, b""
        for batch in batches:
            out, size_of = [], 0
            for r in batch.to_pylist():
                if r["file"] != name:
                    if f:
                        f.close()
                    name, f, start, held = r["file"], store.open_input_file(f"{path}/{r['file']}"), 0, b""
                if not start <= r["offset"] or r["offset"] + r["length"] > start + len(held):
                    f.seek(start := r["offset"])
                    held = f.read(max(READ_AHEAD, r["length"]))
                headers, block = parse(zlib.decompress(held[r["offset"] - start : r["offset"] - start + r["length"]], 31))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                size = int(http.lower().rpartition(b"content-length:")[2])
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{name} is damaged at {r['offset']}")
                refers = _page(headers["warc-refers-to"]) if kind == "revisit" else None
                out.append((_page(headers["warc-record-id"]), headers["warc-target-uri"], size, digest, kind, refers, payload.decode("utf-8", "surrogatepass") if kind == "response" else None)[: len(_RECORD) - (not html)])
                size_of += len(block) if html else 0
                if size_of >= BATCH_BYTES:
                    yield _columns(out, _RECORD[: len(out[0])])
                    out, size_of = [], 0
            yield _columns(out, _RECORD[: len(_RECORD) - (not html)])
        if f:
            f.close()

    ordered = captures.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", html string" * html)


_RECORD = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]


class Archive:
    """Archives, index blocks and directories that store() wrote, the directories from the captures' own upwards."""

    def __init__(self, folder: str, directories: list[DataFrame]):
        self.folder, self.directories = folder, directories
        self._sparse: list | None = None

    @property
    def sparse(self) -> list[tuple]:
        """The topmost directory, DIRECTORY_ROWS entries at most."""
        if self._sparse is None:
            self._sparse = sorted(map(tuple, self.directories[-1].collect()))
        return self._sparse

    def captures(self, urls: DataFrame) -> DataFrame:
        """key, page_id, file, offset, length of all captures of the URLs in the column url, each URL once.

        The keys are bisected in the sparse directory and then, level by level,
        in the blocks that it names.
        """
        keyed = urls.select("url").mapInArrow(_keys, "key string").distinct()
        asked = blocks_with(keyed, self.sparse)
        for level in range(len(self.directories) - 1, 0, -1):
            # a block of a directory says which blocks begin with or before a key: the last one before it, and those with it
            asked = self._below(asked, level)
        return lines_with(asked, f"{self.folder}/index0", "page_id long, file string, offset long, length long")

    def _below(self, asked: DataFrame, level: int) -> DataFrame:
        """The blocks of the level below that may hold the keys, from the directory blocks in asked."""
        folder = f"{self.folder}/index{level}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, path = store_of(folder)
            place, keys, values = None, [], []
            for batch in batches:
                held: list[tuple] = []
                for key, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "shard", "offset", "length"))):
                    if (shard, offset) != place:
                        place = shard, offset
                        with store.open_input_file(f"{path}/{shard}") as f:
                            f.seek(offset)
                            keys, values = [list(x) for x in zip(*_lines(f.read(length)))]
                    at = max(0, bisect_left(keys, key) - 1)
                    held += [(key, *v[:3]) for v in values[at : bisect_right(keys, key)]]
                yield _columns(held, _PLACES)

        dealt = asked.repartition("shard", "offset").sortWithinPartitions("shard", "offset", "key")
        return dealt.mapInArrow(run, "key string, shard string, offset long, length long")

    def records(self, urls: DataFrame, html: bool = True) -> DataFrame:
        """The records of the URLs in the column url, found through the index and read by range."""
        # written, as dealing places out by range looks at them twice
        return read_records(written(self.captures(urls), "places"), f"{self.folder}/archive", html)

    def look_up(self, url: str) -> list[tuple[dict[str, str], bytes]]:
        """The headers and blocks of one URL's records, read by the driver."""
        asked = self.directories[0].sparkSession.createDataFrame([(url,)], "url string")
        store, path = store_of(f"{self.folder}/archive")
        out = []
        for _, _, name, offset, length in self.captures(asked).collect():
            with store.open_input_file(f"{path}/{name}") as f:
                f.seek(offset)
                out.append(parse(zlib.decompress(f.read(length), 31)))
        return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([_plain(url_key(u)) for u in batch.column(0).to_pylist()], pa.string())], names=["key"])


def store(pages: DataFrame, folder: str | None = None) -> Archive:
    """Write pages (page_id, url, html) as archives with their index below folder, a new shared one by default."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = written(write_archives(with_roles(pages), f"{folder}/archive"), "captures")
    directories = []
    while not directories or rows.count() > DIRECTORY_ROWS:
        rows = written(write_blocks(rows, f"{folder}/index{len(directories)}"), "directory")
        directories.append(rows)
    return Archive(folder, directories)
