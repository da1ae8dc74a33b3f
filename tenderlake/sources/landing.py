"""Sources and sinks: landed JSON pages, validated reference tables, lists, and a paged reader."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

T = TypeVar("T")
# How many municipalities there are, and how far a table may be off.
MUNICIPALITIES, TOLERANCE = 1122, 30


def raw_pages(spark: SparkSession, path: str, dataset: str, identity: list[str]) -> DataFrame:
    """Landed rows, a JSON document a line, as raw records: dataset, row_id, hash, content, seen_at."""
    from ..operators import raw

    content = F.col("value")
    fields = [F.get_json_object(content, f"$.{f}") for f in identity]
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_modification_time").alias("seen_at"))
    return lines.select(F.lit(dataset).alias("dataset"), raw.identity(*fields).alias("row_id"), raw.content_hash(content).alias("hash"), content.alias("content"), "seen_at")


def municipalities(spark: SparkSession, path: str, departments: list[str], expected: int = MUNICIPALITIES, tolerance: int = TOLERANCE) -> DataFrame:
    """code and name from CSV; an error where it is empty, has doubled or ill-formed codes, unknown departments or an odd size."""
    table = spark.read.csv(path, header=True, schema="codigo string, nombre string").select(F.col("codigo").alias("code"), F.col("nombre").alias("name"))
    seen = table.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("code").alias("codes"), F.count_if(~F.coalesce(F.col("code").rlike("^[0-9]{5}$"), F.lit(False))).alias("malformed"),
        F.count_if(~F.substring("code", 1, 2).isin(*departments)).alias("unknown"),
    ).first()
    wrong = {"empty": not seen.rows, "doubled codes": seen.codes != seen.rows, "malformed codes": seen.malformed, "unknown departments": seen.unknown, "size": abs(seen.rows - expected) > tolerance}
    if any(wrong.values()):
        raise ValueError(f"{path}: {', '.join(k for k, v in wrong.items() if v)}")
    return table


def id_list(spark: SparkSession, path: str, name: str = "process_id") -> DataFrame:
    """The first word of each line, without comments from # on."""
    first = F.split(F.trim(F.regexp_replace("value", "#.*$", "")), r"\s+")[0]
    return spark.read.text(path).select(first.alias(name)).where(F.col(name) != "").distinct()


def as_document(df: DataFrame, key: str) -> DataFrame:
    """One row with the JSON of a small report block: a list of its rows under key; null for no rows."""
    rows = df.agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    return rows.select(F.to_json(F.struct(F.when(F.size("rows") > 0, F.col("rows")).alias(key)), {"ignoreNullFields": "false"}).alias("document"))


def range_filter(column: str, first: str, last: str) -> Column:
    """Both days included."""
    if first > last:
        raise ValueError("the range is reversed")
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.date_add(F.lit(last).cast("date"), 1))


# Answers after which a request is worth repeating, how often, and the longest wait in seconds.
RETRIED, ATTEMPTS, LONGEST = (202, 408, 425, 429, 500, 502, 503, 504), 5, 60.0


class Failed(OSError):
    """An answer that is no page: its status, and the seconds that it asks to wait, if it does."""

    def __init__(self, status: int, wait: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.wait = status, wait


def waits(attempts: int = ATTEMPTS, longest: float = LONGEST, chance: Callable[[], float] = random.random) -> Iterator[float]:
    """Seconds to wait after each attempt: 2 after the first, doubled each time, up to longest, and spread to a half at least."""
    for n in range(attempts - 1):
        yield min(longest, 2.0 ** (n + 1)) * (0.5 + chance() / 2)


def with_retries(ask: Callable[[], T], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep, chance: Callable[[], float] = random.random) -> T:
    """What ask() returns. After a failed connection or an answer in RETRIED it is asked again; other answers are errors at once.

    A reader runs it inside its tasks, a page a task.
    """
    for pause in (*waits(attempts, chance=chance), None):
        try:
            return ask()
        except Failed as e:
            if pause is None or e.status not in RETRIED:
                raise
            sleep(min(LONGEST, e.wait) if e.wait is not None else pause)
        except (ConnectionError, TimeoutError):
            if pause is None:
                raise
            sleep(pause)
    raise AssertionError


class _Page(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PagedReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_Page(str(p)) for p in sorted(Path(self.folder).glob("page-*.json"))]

    def read(self, partition: _Page) -> Iterator[tuple]:
        import json

        for i, row in enumerate(json.loads(with_retries(lambda: Path(partition.path).read_text(encoding="utf-8")))):
            yield Path(partition.path).name, i, json.dumps(row, ensure_ascii=False)


class PagedSource(DataSource):
    """spark.read.format("paged").load(folder): pages as a paging service returns them, a task a page."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page string, place int, content string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options["path"])
