"""As-of join: for each row the newest row of the other side that is not later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys are counted by this many hashes; a hash with more than HOT rows of both sides has its keys cut by time.
HASHES, HOT = 65_536, 200_000


def as_of(left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, values: Sequence[str], order: Sequence[Column] = (), slice: str = "month", hot: int = HOT) -> DataFrame:
    """left with values of the row of right that has the same on and the greatest right_at up to left_at; nulls where there is none.

    Of several right rows of one moment the last in the given order counts. Rows
    of left without a time, or with a null among on, have none. No left row is
    lost or repeated, and left's other columns stay, whatever their names.

    Both sides are one sequence, shuffled and sorted once; the last right row so
    far is carried forward. Keys of many rows are sequences by slices of time, so
    no task has a hot key whole: what a slice begins with, the last right row of
    the slices before it, comes from one row a key and slice. All other keys have
    one slice and need no such rows. slice is a unit of trunc().
    """
    keys = [f"__k{i}" for i in range(len(on))]
    kinds = {c: right.schema[c].dataType for c in [*on, *values]}
    part = lambda t: F.date_trunc(slice, t.cast("timestamp"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASHES)).cast("int")
    own = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    a = left.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(k) for c, k in zip(on, keys)), F.col(f"`{left_at}`").cast("timestamp").alias("__at"), own.alias("__own"))
    whole = F.col("__at").isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    found = F.struct(*(F.col(f"`{c}`") for c in values))
    b = right.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), F.col(f"`{right_at}`").cast("timestamp").alias("__at"), found.alias("__found"), F.struct(*order, F.lit(0)).alias("__order")).where(whole).withColumn("__bucket", bucket)
    asked = a.where(whole).withColumn("__bucket", bucket)
    counts = asked.select("__bucket").unionByName(b.select("__bucket")).groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # at most HASHES rows at any size of the tables
    crowded = F.broadcast(counts.where(F.col("__n") > hot).select("__bucket", F.lit(True).alias("__hot")))
    asked = asked.join(crowded, "__bucket", "left").withColumn("__slice", F.when(F.col("__hot"), part(F.col("__at")))).drop("__bucket")
    few = b.join(crowded, "__bucket", "left_anti").drop("__bucket")
    # of one moment only the last counts, which also keeps a hot moment out of the sort
    many = b.join(crowded, "__bucket", "left_semi").groupBy(*keys, "__at").agg(F.max_by("__found", "__order").alias("__found")).withColumn("__slice", part(F.col("__at")))
    both = asked.drop("__hot").withColumn("__asks", F.lit(1)).unionByName(few.withColumn("__asks", F.lit(0)), True).unionByName(many.withColumn("__asks", F.lit(0)), True)
    w = Window.partitionBy(*keys, "__slice").orderBy("__at", "__asks", "__order").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__last", F.last("__found", True).over(w)).where("__asks = 1")
    # the last right row of each key and slice, and which slice's a later one begins with
    ends = many.groupBy(*keys, "__slice").agg(F.max_by("__found", "__at").alias("__end"))
    slices = ends.unionByName(asked.where("__hot").select(*keys, "__slice").distinct(), True).groupBy(*keys, "__slice").agg(F.first("__end", True).alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = slices.withColumn("__begin", F.last("__end", True).over(before)).select(*keys, "__slice", "__begin")
    out = carried.join(begins, [*keys, "__slice"], "left").select("__own", F.coalesce("__last", "__begin").alias("__found"))
    out = out.unionByName(a.where(~whole).select("__own", F.lit(None).cast(b.schema["__found"].dataType).alias("__found")))
    return out.select(*(F.col("__own")[c].alias(c) for c in left.columns), *(F.col("__found")[c].alias(c) for c in values))
