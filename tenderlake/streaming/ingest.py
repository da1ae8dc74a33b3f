"""Streaming forms of the raw layer: exactly-once appends and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.raw import append_new, content_hash
from ..sources.store import Store, Transaction


def append_stream(stream: DataFrame, target: str, checkpoint: str, key: tuple[str, ...] = ("dataset", "row_id", "hash"), overlap: str | None = None) -> StreamingQuery:
    """Append a stream of raw rows (dataset, row_id, content, seen_at) to a Parquet table, each version once.

    A batch writes its own folder of the table, batch=N, in overwrite mode, so a
    batch that runs again after a failure replaces what it wrote. Late rows are
    kept: there is no watermark that would drop them. With overlap ("45 days", as
    long as sources repeat rows) a batch is compared only with rows seen since
    that long before its own first row, so what it reads does not grow with the
    table's age; a version that comes back later than that is a row again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("hash", content_hash(F.col("content")))
        seen = _earlier(spark, target, number, rows)
        if overlap:
            since = rows.agg((F.min("seen_at") - F.expr(f"INTERVAL {overlap}")).alias("t")).first().t
            seen = seen.where(F.col("seen_at") >= F.lit(since)) if since else seen
        fresh = append_new(seen, rows, list(key), "row_id")
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _earlier(spark: SparkSession, target: str, number: int, rows: DataFrame) -> DataFrame:
    """What batches before this one have written."""
    schema = T.StructType([*rows.schema.fields, T.StructField("is_new", T.BooleanType()), T.StructField("batch", T.LongType())])
    if number == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target).where(F.col("batch") < number)


def windowed(events: DataFrame, size: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts and sums by window and event type; on a stream, state older than late is dropped."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """Sessions of each user: start, end and events."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def insert_stream(stream: DataFrame, store: Store, checkpoint: str, table: str = "raw", key: tuple[str, ...] = ("dataset", "row_id", "hash"), id: tuple[str, ...] = ("dataset", "row_id"), buckets: int = 64) -> StreamingQuery:
    """Append a stream of raw rows (dataset, row_id, content, seen_at) to a store's table, each version once, whenever it comes again.

    History is laid out by a hash of the id: a batch reads the keys of the
    buckets that its rows fall into. Rows and the batch's number are one commit,
    so a batch that runs again after a failure adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        def change(tx: Transaction) -> None:
            if tx.record["values"].get("stream", {}).get(checkpoint, -1) >= number:
                return
            tx.insert(table, batch.withColumn("hash", content_hash(F.col("content"))), list(key), list(id), buckets)
            tx.put("stream", checkpoint, number)

        store.retried(change)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_versions(stream: DataFrame) -> DataFrame:
    """On a stream of (row_id, ts, content): each row_id's newest content, of several at one time the largest, with how many contents it has had."""
    newest = F.max_by("content", F.struct("ts", "content"))
    seen = F.size(F.collect_set(F.xxhash64("content"))).cast("long")
    return stream.groupBy("row_id").agg(F.max("ts").alias("ts"), newest.alias("content"), seen.alias("changes"))
