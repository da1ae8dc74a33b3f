"""A store of tables whose changes are committed together.

A store is a folder with data folders and numbered commit records. A record names
the data of every table and holds the values kept beside them (watermarks, say);
a state of the store is its last record. A transaction writes data first, which
nobody sees, and its record last; so rows, watermark and cycle log change at once
or not at all, and what an aborted run leaves is unreferenced. A record is never
overwritten: of two writers that start from one state the second gets Conflict
and can begin again from the new one.

Tables are keyed or logs. A keyed table is laid out by a hash of its key, and an
upsert reads and rewrites the buckets that incoming keys fall into, no others. A
log grows by a folder a commit; when these are many they are written as one.

The folder's file system must rename files atomically and refuse to rename over
an existing one, as HDFS does.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.raw import latest

#: Folders of a log beyond which an append writes them as one.
FOLDERS = 50


class Conflict(RuntimeError):
    """Another writer has committed since this transaction began."""


def rename_new(spark: SparkSession, old, new) -> None:
    """Rename a file or folder (Hadoop paths); Conflict if the new name is taken."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    context = hadoop.FileContext.getFileContext(old.getFileSystem(conf).getUri(), conf)
    nothing = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(old, new, nothing)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "exists" in str(e).lower():
            raise Conflict(f"{new} was made by another writer") from None
        raise


class Store:
    """The committed states below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []

    def versions(self) -> list[int]:
        """The numbers of all commits, the first one 1."""
        return sorted(int(n[:-5]) for n in self._names("commits") if re.fullmatch(r"[0-9]+\.json", n))

    def record(self, version: int | None = None) -> dict:
        """A commit's record, by default the last one's; an empty one where there are none."""
        made = self.versions()
        if version is None and not made:
            return {"version": 0, "tables": {}, "values": {}}
        stream = self._files.open(self._at(f"commits/{made[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a commit."""
        return self._rows(self.record(version)["tables"][table])

    def _rows(self, table: Mapping, buckets: Sequence[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(table["schema"])
        folders = sorted({f for b, fs in table["folders"].items() if buckets is None or b in buckets for f in fs})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def values(self, version: int | None = None) -> dict:
        """What is kept beside the tables."""
        return self.record(version)["values"]

    def begin(self) -> "Transaction":
        return Transaction(self)

    def retried(self, change: Callable[["Transaction"], None], times: int = 5) -> int:
        """Commit change(transaction), again from the new state when another writer was first; the version."""
        for left in range(times, 0, -1):
            tx = self.begin()
            try:
                change(tx)
                return tx.commit()
            except Conflict:
                if left == 1:
                    raise
            except BaseException:
                tx.abort()
                raise
        raise AssertionError

    def collect(self, keep: int = 2, older_than: float = 24 * 3600) -> list[str]:
        """Remove the records before the last keep ones, and data folders that no remaining record names.

        Folders younger than older_than seconds stay: a transaction may be about
        to commit them. Returns what was removed.
        """
        made = self.versions()
        for v in made[:-keep] if keep else []:
            self._files.delete(self._at(f"commits/{v}.json"), False)
        used = {f for v in self.versions() for t in self.record(v)["tables"].values() for fs in t["folders"].values() for f in fs}
        now, gone = datetime.now(timezone.utc).timestamp(), []
        for name in (f"data/{n}" for n in self._names("data")):
            if now - self._files.getFileStatus(self._at(name)).getModificationTime() / 1000 < older_than:
                continue
            # a folder goes as a whole, or the buckets that later commits have replaced
            buckets = [f"{name}/{n}" for n in self._names(name) if n.startswith("__bucket=")]
            unused = [b for b in buckets if b not in used] if used & {name, *buckets} else [name]
            for folder in unused:
                self._files.delete(self._at(folder), True)
            gone += unused
        return gone


@dataclass(frozen=True)
class Incoming:
    """The rows of an upsert, written by bucket."""

    table: str
    folder: str
    rows: DataFrame
    buckets: list[str]
    bucket: Column


class Transaction:
    """Changes on top of one state; nothing of them is seen before commit()."""

    def __init__(self, store: Store):
        self.store = store
        self.record = store.record()
        self.base = self.record["version"]
        self._written: list[str] = []
        self._passing: list[str] = []

    def _folder(self, table: str) -> str:
        name = f"data/{uuid.uuid4().hex}-{table}"
        self._written.append(name)
        return name

    def read(self, table: str) -> DataFrame:
        """A table with what this transaction has changed."""
        return self.store._rows(self.record["tables"][table])

    def _table(self, name: str, schema: T.StructType, kind: str, keys: Sequence[str] = (), buckets: int = 0) -> dict:
        found = self.record["tables"].setdefault(name, {"kind": kind, "keys": list(keys), "buckets": buckets, "schema": schema.jsonValue(), "folders": {}})
        if found["kind"] != kind or found["keys"] != list(keys):
            raise ValueError(f"{name} is a {found['kind']} table with keys {found['keys']}")
        if [f["name"] for f in found["schema"]["fields"]] != schema.names:
            raise ValueError(f"{name} has the columns {[f['name'] for f in found['schema']['fields']]}")
        return found

    def upsert(self, table: str, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), buckets: int = 64, by: Sequence[str] = ()) -> int:
        """Replace all columns of the rows whose keys come again and add the others; the number of buckets rewritten.

        Of several incoming rows of a key the first in the given order counts. A
        key may hold nulls. buckets is set when the table is made: rows by
        buckets is what one task of an upsert handles. by is some of the keys and
        sets the bucket, always the same ones for a table; by default all do.
        """
        return self.merge(self.incoming(table, rows, keys, order, buckets, by))

    def incoming(self, table: str, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), buckets: int = 64, by: Sequence[str] = ()) -> Incoming:
        """The first half of an upsert: rows, each key once, written by bucket. They are made once, whatever else is made from them before merge()."""
        found = self._table(table, rows.schema, "keyed", keys, buckets)
        bucket = F.pmod(F.xxhash64(*(by or keys)), F.lit(found["buckets"])).cast("int")
        dealt = rows.withColumn("__bucket", bucket).repartitionById(found["buckets"], "__bucket")
        # rows of a key are in one task already: neither form shuffles again
        once = latest(dealt, ["__bucket", *keys], list(order)) if order else dealt.dropDuplicates(["__bucket", *keys])
        folder = self._folder(f"{table}-incoming")
        once.write.partitionBy("__bucket").parquet(f"{self.store.path}/{folder}")
        return Incoming(table, folder, self.store.spark.read.schema(once.schema).parquet(f"{self.store.path}/{folder}"), self._buckets(folder), bucket)

    def merge(self, come: Incoming) -> int:
        """The second half of an upsert. Where a table has nothing yet the incoming rows are its buckets as they were written."""
        found = self.record["tables"][come.table]
        touched, made = come.buckets, come.folder
        if not touched:
            self._passing.append(come.folder)
        elif any(b in found["folders"] for b in touched):
            made = self._folder(come.table)
            self._passing.append(come.folder)
            old = self.store._rows(found, touched).withColumn("__bucket", come.bucket).withColumn("__new", F.lit(False))
            both = old.unionByName(come.rows.withColumn("__new", F.lit(True))).repartitionById(found["buckets"], "__bucket")
            rows = latest(both, ["__bucket", *found["keys"]], [F.desc("__new")]).drop("__new")
            rows.write.partitionBy("__bucket").parquet(f"{self.store.path}/{made}")
        for b in touched:
            found["folders"][b] = [f"{made}/__bucket={b}"]
        return len(touched)

    def insert(self, table: str, rows: DataFrame, keys: Sequence[str], id: Sequence[str], buckets: int = 64) -> DataFrame:
        """Add the rows whose keys are new, once each; they come back with is_new: whether even their id is.

        id is some of the keys and sets the bucket. Only the ids and keys of the
        buckets that rows fall into are read, and no bucket is rewritten but
        those that have many folders.
        """
        found = self._table(table, rows.schema, "keyed", keys, buckets)
        n, bucket = found["buckets"], F.pmod(F.xxhash64(*id), F.lit(found["buckets"])).cast("int")
        come, made = rows.withColumn("__bucket", bucket), self._folder(table)
        if not found["folders"]:
            fresh = come.repartitionById(n, "__bucket").dropDuplicates(["__bucket", *keys]).withColumn("is_new", F.lit(True))
        else:
            # written by bucket, as they are needed to know the buckets and then again
            folder = self._folder(f"{table}-incoming")
            self._passing.append(folder)
            come.repartitionById(n, "__bucket").write.partitionBy("__bucket").parquet(f"{self.store.path}/{folder}")
            come = self.store.spark.read.schema(come.schema).parquet(f"{self.store.path}/{folder}")
            old = self.store._rows(found, self._buckets(folder)).select(*dict.fromkeys([*id, *keys])).withColumn("__bucket", bucket)
            both = come.withColumn("__old", F.lit(False)).unionByName(old.withColumn("__old", F.lit(True)), allowMissingColumns=True).repartitionById(n, "__bucket")
            # by bucket, id and key in one order: one shuffle and one sort for what is known of keys and ids
            one = latest(both, list(dict.fromkeys(["__bucket", *id, *keys])), [F.desc("__old")])
            known = one.withColumn("__known", F.max("__old").over(Window.partitionBy("__bucket", *id)))
            fresh = known.where("NOT __old").withColumn("is_new", ~F.col("__known")).drop("__old", "__known")
        fresh.write.partitionBy("__bucket").parquet(f"{self.store.path}/{made}")
        for b in self._buckets(made):
            folders = found["folders"].setdefault(b, [])
            folders.append(f"{made}/__bucket={b}")
            if len(folders) > FOLDERS:
                whole = self._folder(table)
                self.store._rows(found, [b]).coalesce(1).write.parquet(f"{self.store.path}/{whole}")
                folders[:] = [whole]
        schema = T.StructType([*rows.schema.fields, T.StructField("is_new", T.BooleanType())])
        return self.store.spark.read.schema(schema).parquet(f"{self.store.path}/{made}")

    def has_rows(self, table: str) -> bool:
        """Whether anything was ever put into a table."""
        return bool(self.record["tables"].get(table, {}).get("folders"))

    def _buckets(self, folder: str) -> list[str]:
        return sorted((n.split("=")[1] for n in self.store._names(folder) if n.startswith("__bucket=")), key=int)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a log."""
        found = self._table(table, rows.schema, "log")
        folders = found["folders"].setdefault("all", [])
        if len(folders) >= FOLDERS:
            whole = self._folder(table)
            self.store._rows(found).write.parquet(f"{self.store.path}/{whole}")
            folders[:] = [whole]
        made = self._folder(table)
        rows.write.parquet(f"{self.store.path}/{made}")
        folders.append(made)

    def kept(self, rows: DataFrame, name: str) -> DataFrame:
        """rows written for the time of the transaction, as they are before it changes what they come from."""
        folder = self._folder(name)
        self._passing.append(folder)
        rows.write.parquet(f"{self.store.path}/{folder}")
        return self.store.spark.read.schema(rows.schema).parquet(f"{self.store.path}/{folder}")

    def put(self, kind: str, key: str, value) -> None:
        """Set a value beside the tables; it must have a JSON form."""
        self.record["values"].setdefault(kind, {})[key] = value

    def commit(self) -> int:
        """Make the changes the store's state; Conflict if it has another by now."""
        files = self.store._files
        number = self.base + 1
        self.record["version"] = number
        beside = self.store._at(f"commits/.{uuid.uuid4().hex}")
        files.mkdirs(self.store._at("commits"))
        stream = files.create(beside, False)
        stream.write(bytearray(json.dumps(self.record).encode()))
        stream.close()
        try:
            rename_new(self.store.spark, beside, self.store._at(f"commits/{number}.json"))
        except BaseException:
            files.delete(beside, False)
            self.abort()
            raise
        for folder in self._passing:
            files.delete(self.store._at(folder), True)
        return number

    def abort(self) -> None:
        """Remove what was written. Without it collect() does so later."""
        while self._written:
            self.store._files.delete(self.store._at(self._written.pop()), True)
