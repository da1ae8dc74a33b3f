"""Pages of rows with a day each: landed with an index, read by range, and followed as a stream.

A page is a JSON list, as a paging service returns it. Landing is a Spark job:
rows are dealt to ranges of days, so a page's days lie close together, and the
index has a line for each page with its first and last day. The index is written
after the pages; a page that it does not name is not there.

    spark.read.format("dated_pages").load(folder)        with filters on day pushed down to the index
    spark.readStream.format("dated_pages").load(folder)  offsets are days; each batch reads an overlap again

Filters reach the source where spark.sql.python.filterPushdown.enabled is set.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.incremental import OVERLAP_DAYS
from .landing import with_retries

#: Rows of a page, as the service gives them.
PAGE = 1000
#: Tasks up to which each page has its own, and the rows that a task of several pages has at most.
TASKS, ROWS = 64, 50_000
SCHEMA = "page string, place int, day date, content string"


def _store(path: str):
    """A folder's file system and the path in it, for the driver and for tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)


def index(folder: str) -> list[dict]:
    """The pages of a folder: page, first, last (days as text), rows and landed, the number of the landing."""
    from pyarrow import fs

    store, path = _store(folder)
    out = []
    for f in store.get_file_info(fs.FileSelector(f"{path}/index", allow_not_found=True)):
        if f.base_name.endswith(".json") and f.base_name.startswith("part-"):
            with store.open_input_stream(f.path) as stream:
                out += [json.loads(line) for line in stream.read().decode().splitlines()]
    return sorted(out, key=lambda x: x["page"])


def land(rows: DataFrame, folder: str, size: int = PAGE) -> int:
    """Write rows (day, content) as pages beside those that are there; the number of this landing, from 1.

    Rows without a day have none to be found by, and pages of their own. A task
    that runs again writes the same pages again.
    """
    number = max((x["landed"] for x in index(folder)), default=0) + 1

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(f"{path}/pages", recursive=True)
        part, made, held = TaskContext.get().partitionId(), 0, []

        def out(page: list[tuple]) -> pa.RecordBatch:
            name = f"page-{number:06}-{part:06}-{made:06}.json"
            with store.open_output_stream(f"{path}/pages/{name}") as stream:
                stream.write(json.dumps([{"day": d and d.isoformat(), "content": c} for d, c in page], ensure_ascii=False).encode())
            days = [d.isoformat() for d, _ in page if d]
            return pa.RecordBatch.from_pydict({"page": [name], "first": pa.array([min(days, default=None)], pa.string()), "last": pa.array([max(days, default=None)], pa.string()), "rows": pa.array([len(page)], pa.int64()), "landed": pa.array([number], pa.int64())})

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(held) == size or held and (held[-1][0] is None) != (row[0] is None):
                    yield out(held)
                    made, held = made + 1, []
                held.append(row)
        if held:
            yield out(held)

    dealt = rows.select(F.col("day").cast("date").alias("day"), F.col("content").cast("string").alias("content")).repartitionByRange("day", F.xxhash64("content")).sortWithinPartitions("day", "content")
    dealt.mapInArrow(write, "page string, first string, last string, rows long, landed long").write.mode("append").json(f"{folder}/index")
    return number


class _Pages(InputPartition):
    """Pages that a task reads one after the other."""

    def __init__(self, names: list[str], first: str | None, last: str | None):
        self.names, self.first, self.last = names, first, last


def _rows(folder: str, pages: _Pages | None) -> Iterator[tuple]:
    """Pages' rows from first to last; without either all, also those without a day. No pages, as Spark asks for where there are none, have no rows."""
    if pages is None:
        return
    store, path = _store(folder)
    for name in pages.names:

        def ask() -> list[dict]:
            with store.open_input_stream(f"{path}/pages/{name}") as stream:
                return json.loads(stream.read())

        for i, row in enumerate(with_retries(ask)):
            day = row["day"]
            if pages.first is None and pages.last is None or day is not None and (pages.first or "") <= day and (pages.last is None or day <= pages.last):
                yield name, i, day and date.fromisoformat(day), row["content"]


def _within(pages: Iterable[dict], first: str | None, last: str | None) -> list[_Pages]:
    """The pages that may have rows of a range of days, in tasks; days as text compare as days do.

    Few pages have a task each. Of many a task has several, as small pages take
    less time than a task's start, up to a number of rows.
    """
    if first is not None or last is not None:
        pages = [x for x in pages if x.get("first") and (first is None or x["last"] >= first) and (last is None or x["first"] <= last)]
    pages = list(pages)
    largest = max((x["rows"] for x in pages), default=1)
    n = max(1, min(-(-len(pages) // TASKS), ROWS // largest))
    return [_Pages([x["page"] for x in pages[i : i + n]], first, last) for i in range(0, len(pages), n)]


class DatedReader(DataSourceReader):
    """Reads the pages of the range that filters on day leave. Spark applies all filters again to the rows."""

    def __init__(self, folder: str):
        self.folder, self.first, self.last = folder, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("day",) and isinstance(getattr(f, "value", None), date):
                day = f.value
                low = day if isinstance(f, (EqualTo, GreaterThanOrEqual)) else day + timedelta(1) if isinstance(f, GreaterThan) else None
                high = day if isinstance(f, (EqualTo, LessThanOrEqual)) else day - timedelta(1) if isinstance(f, LessThan) else None
                self.first = max(filter(None, (self.first, low and low.isoformat())), default=None)
                self.last = min(filter(None, (self.last, high and high.isoformat())), default=None)
            yield f

    def partitions(self) -> list[InputPartition]:
        return _within(index(self.folder), self.first, self.last)

    def read(self, partition: _Pages) -> Iterator[tuple]:
        return _rows(self.folder, partition)


class DatedStream(DataSourceStreamReader):
    """Follows landings. The offset is the watermark, the newest day landed, with the landing's number.

    A batch reads from overlap days before the last offset's day, also pages that
    were read before: what comes twice is for the sink to tell. The first batch
    reads from the option start on, or everything. What is older than the overlap
    is read by range, as a backfill.
    """

    def __init__(self, folder: str, overlap: int, start: str | None):
        self.folder, self.overlap, self.start = folder, overlap, start

    def initialOffset(self) -> dict:
        return {"day": "", "landed": 0}

    def latestOffset(self) -> dict:
        pages = index(self.folder)
        return {"day": max((x["last"] for x in pages if x.get("last")), default=""), "landed": max((x["landed"] for x in pages), default=0)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first = (date.fromisoformat(start["day"]) - timedelta(self.overlap)).isoformat() if start["day"] else self.start
        return _within((x for x in index(self.folder) if x["landed"] <= end["landed"]), first, end["day"] if first else None)

    def read(self, partition: _Pages) -> Iterator[tuple]:
        return _rows(self.folder, partition)

    def commit(self, end: dict) -> None:
        """Pages stay where they are."""


class DatedPages(DataSource):
    """The format dated_pages, over a folder that land() has written. Options of streams: overlap (days) and start (a day)."""

    @classmethod
    def name(cls) -> str:
        return "dated_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return DatedReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return DatedStream(self.options["path"], int(self.options.get("overlap", OVERLAP_DAYS)), self.options.get("start"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let filters reach it."""
    spark.dataSource.register(DatedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
