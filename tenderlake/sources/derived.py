"""Sinks for derived tables: full rewrites, upserts by key, and dry runs.

A table is a folder of numbered versions. A version is written beside the one
that is read and gets its number by a rename that never replaces anything, so
readers never see half a table, a failed rewrite costs nothing, and of two
writers the second gets Conflict. Versions before the last KEPT are removed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.raw import latest
from .store import rename_new

#: Versions that stay for those who still read them.
KEPT = 2
#: The derived tables and their keys.
KEYS = {
    "process": ["process_id"],
    "contract": ["contract_id"],
    "supplier": ["supplier_type", "supplier_number"],
    "variant": ["supplier_type", "supplier_number", "name"],
}


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new, which has each key once, in place of those of the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


class DerivedTable:
    """A table that is rewritten as a whole or has rows replaced by key."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def versions(self) -> list[int]:
        """The numbers of the versions whose writes were committed."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(root):
            return []
        found = []
        for s in store.listStatus(root):
            name = s.getPath().getName()
            if re.fullmatch("v[0-9]+", name) and store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                found.append(int(name[1:]))
        return sorted(found)

    def read(self) -> DataFrame:
        made = self.versions()
        if not made:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/v{made[-1]}")

    def rewrite(self, rows: DataFrame) -> DataFrame:
        """Replace the whole table by rows, which must have each key once."""
        made, hadoop = self.versions(), self.spark._jvm.org.apache.hadoop.fs
        beside, to = (hadoop.Path(f"{self.path}/{n}") for n in (f".new-{uuid.uuid4().hex}", f"v{max(made, default=-1) + 1}"))
        store = beside.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            rows.write.parquet(beside.toString())
            rename_new(self.spark, beside, to)
        except BaseException:
            store.delete(beside, True)
            raise
        for v in made[: -(KEPT - 1)]:
            store.delete(hadoop.Path(f"{self.path}/v{v}"), True)
        return self.read()

    def upsert(self, rows: DataFrame, order: list[Column]) -> DataFrame:
        """Replace all columns of the rows whose keys come again, and add the others.

        Of several incoming rows of a key the first in the given order counts.
        """
        new = latest(rows, self.keys, order)
        if not self.versions():
            return self.rewrite(new)
        return self.rewrite(upserted(self.read(), new, self.keys))


class DryRun:
    """A sink that writes nothing: what it is given is counted, and 0 rows are said to be inserted."""

    def __init__(self):
        self.seen = 0

    def rewrite(self, rows: DataFrame) -> int:
        self.seen += rows.count()
        return 0

    def upsert(self, rows: DataFrame, order: list[Column]) -> int:
        return self.rewrite(rows)
