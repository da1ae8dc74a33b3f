"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

#: The white space that separates words: space and the controls from tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"

_folders: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is spark.checkpoint.dir where that is set. Only a local session without
    it gets a temporary folder; elsewhere its absence is an error.
    """
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}-{name}"
    _folders.append(path)
    return path


def release() -> None:
    """Remove what this process has written to the shared folder. DataFrames that read it end with it."""
    from pyarrow import fs

    while _folders:
        store, path = store_of(_folders.pop())
        if store.get_file_info(path).type == fs.FileType.Directory:
            store.delete_dir(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: it is computed once and outlives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_of(path: str):
    """The file system and the path in it of a folder below shared_dir(), for use in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)


def aside(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """df with columns named by their place (__0, __1 ...), and what selects them back under their own names.

    What an operator adds can then clash with no name of the input, whatever it is.
    """
    columns = df.columns
    return df.toDF(*(f"__{i}" for i in range(len(columns)))), [F.col(f"__{i}").alias(c) for i, c in enumerate(columns)]


def placed(df: DataFrame, name: str) -> str:
    """The name that aside() gives df's column."""
    return f"__{place(df.columns, name)}"


def place(columns: Sequence[str], name: str) -> int:
    """Where a column stands; names are alike as Spark has it by default, whatever their case."""
    found = [i for i, c in enumerate(columns) if c == name] or [i for i, c in enumerate(columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name} among {', '.join(columns)}")
    return found[0]


def without(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """The columns that have none of the names, whatever their case."""
    low = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in low]


def with_columns(df: DataFrame, source: str, out: str | T.StructType, row: Callable[[], Callable[[str | None], Sequence]], keep: Sequence[str] | None = None) -> DataFrame:
    """df's columns (or those in keep) and the columns of the DDL string out, made from the text column source.

    row() is called once a task and returns a function from one text to one
    tuple. Columns of df with a name from out are replaced; no other name of df
    clashes with anything.
    """
    made = T._parse_datatype_string(out) if isinstance(out, str) else out
    names = [f.name for f in made.fields]
    kept = without(df.columns if keep is None else keep, names)
    at = [place(df.columns, c) for c in kept]
    schema = T.StructType([T.StructField(c, df.schema.fields[i].dataType, df.schema.fields[i].nullable) for c, i in zip(kept, at)] + made.fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, one = to_arrow_schema(schema), row()
        for batch in batches:
            # Small slices bound what Python holds when single texts are very long.
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                values = [one(x) for x in part.column(len(at)).to_pylist()]
                columns = list(zip(*values)) if values else [[] for _ in names]
                arrays = [part.column(i).cast(field.type) for i, field in zip(range(len(at)), arrow)]
                arrays += [pa.array(v, arrow.field(len(at) + i).type) for i, v in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    moved, _ = aside(df)
    return moved.select(*(F.col(f"__{i}").alias(f"c{k}") for k, i in enumerate(at)), F.col(placed(df, source)).alias("text")).mapInArrow(rows, schema)
