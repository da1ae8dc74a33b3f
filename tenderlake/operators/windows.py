"""Ranks, running sums and overlapping intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import orderstats

#: Keys are counted by this many hashes; a hash with more than HOT intervals has its keys' dealt to months.
HASHES, HOT = 1 << 20, 1000


def attention(df: DataFrame, group: str, by: str, level: float, unusual: Column, k: int, tie: str) -> DataFrame:
    """The k unusual rows with the highest by among those whose percent rank within group is level or more.

    Ranks are over all rows; unusual is tested afterwards.
    """
    return orderstats.with_percent_rank(df, [group], by).where((F.col("rank") >= level) & unusual).orderBy(F.desc(by), tie).limit(k)


def peak_concurrency(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The largest number of each key's intervals that hold one day; both ends included.

    An interval closes the day after its end, so one that begins then does not
    overlap it. Starts and ends are summed by day before the running sum.
    """
    opens = df.select(key, F.col(start).alias("day"), F.lit(1).alias("delta"))
    closes = df.select(key, F.date_add(end, 1).alias("day"), F.lit(-1).alias("delta"))
    by_day = opens.unionByName(closes).groupBy(key, "day").agg(F.sum("delta").alias("delta"))
    running = F.sum("delta").over(Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return by_day.withColumn("open", running).groupBy(key).agg(F.max("open").alias("peak"))


def dealt(df: DataFrame, key: str, row_id: str, start: str, end: str, other: str, hot: int = HOT) -> DataFrame:
    """key, row_id, s, e, o and month: intervals of busy keys once for each month that they touch, others once without a month."""
    rows = df.where(F.col(end) >= F.col(start)).select(key, row_id, F.col(start).alias("s"), F.col(end).alias("e"), F.col(other).alias("o"), F.pmod(F.xxhash64(key), F.lit(HASHES)).cast("int").alias("__bucket"))
    # at most HASHES rows at any size of the table
    busy = F.broadcast(rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot).select("__bucket", F.lit(True).alias("__busy")))
    months = F.when(F.col("__busy"), F.sequence(F.trunc("s", "month"), F.trunc("e", "month"), F.expr("INTERVAL 1 MONTH"))).otherwise(F.array(F.lit(None).cast("date")))
    return rows.join(busy, "__bucket", "left").select(key, row_id, "s", "e", "o", F.explode(months).alias("month"))


def overlaps(df: DataFrame, key: str, row_id: str, start: str, end: str, other: str, hot: int = HOT) -> DataFrame:
    """Pairs of one key's intervals that overlap and differ in other: a_id, b_id, days.

    Keys of few intervals meet as a whole, an interval a row. Those of more are
    dealt to the months that they touch and pairs are looked for within a month;
    a pair counts in the first month that both touch. So the intervals of a busy
    key are split by time instead of meeting in one task.
    """
    rows = dealt(df, key, row_id, start, end, other, hot)
    a, b = rows.alias("a"), rows.alias("b")
    first = F.trunc(F.greatest("a.s", "b.s"), "month")
    on = (F.col(f"a.{key}") == F.col(f"b.{key}")) & F.col("a.month").eqNullSafe(F.col("b.month")) & (F.col(f"a.{row_id}") < F.col(f"b.{row_id}")) & (F.col("a.s") <= F.col("b.e")) & (F.col("b.s") <= F.col("a.e"))
    pairs = a.join(b, on).where((F.col("a.month").isNull() | (F.col("a.month") == first)) & ~F.col("a.o").eqNullSafe(F.col("b.o")))
    days = F.date_diff(F.least("a.e", "b.e"), F.greatest("a.s", "b.s")) + 1
    return pairs.select(F.col(f"a.{key}").alias(key), F.col(f"a.{row_id}").alias("a_id"), F.col(f"b.{row_id}").alias("b_id"), F.col("a.o").alias("a_other"), F.col("b.o").alias("b_other"), days.alias("days"))


def stretches(df: DataFrame, key: str, start: str, end: str, other: str) -> DataFrame:
    """key, o, s, e: the stretches of days that intervals of one key and other cover without a gap.

    Intervals that begin on one day are one before the window, so it has no more
    rows of a key and other than there are days.
    """
    valid = df.where(F.col(key).isNotNull() & (F.col(end) >= F.col(start)))
    rows = valid.groupBy(key, F.col(other).alias("o"), F.col(start).alias("s")).agg(F.max(end).alias("e"))
    w = Window.partitionBy(key, "o").orderBy("s")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("s") > reach), 1).otherwise(0)
    numbered = rows.withColumn("opens", opens).withColumn("n", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "o", "n").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("n")


def partners(df: DataFrame, key: str, start: str, end: str, other: str) -> DataFrame:
    """How many different others each key has among its intervals that overlap one of another other.

    No pairs are made: one other's stretches never meet, so a stretch overlaps
    another other's if one that begins earlier ends after its start or if the
    next one begins before its end. Null is an other, but is not counted.
    """
    w = Window.partitionBy(key).orderBy("s", "o")
    before, after = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lead("s").over(w)
    met = F.coalesce(before >= F.col("s"), F.lit(False)) | F.coalesce(after <= F.col("e"), F.lit(False))
    return stretches(df, key, start, end, other).withColumn("met", met).where("met").groupBy(key).agg(F.countDistinct("o").alias("others"))
