"""Exact percentiles and ranks within groups of any size.

No buffer, sort or window holds a group. Values are counted once by group and
value, with partial counts before the shuffle, so a value that a third of all
rows share is a row a task. The counts of one group are cut into cells twice: by
steps of the value's logarithm, of which a group has a bounded number, and each
of these by equal steps between its own least and greatest value. Windows run
over a group's cells, over a cell's parts and over a part's different values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a doubling of the value, and parts of a cell.
STEPS, PARTS = 256, 65_536


def _cell(v: Column) -> Column:
    """A whole number that never falls as v rises: sign and logarithm. Not a number is greatest, as in Spark's order."""
    # infinity has a cell of its own beyond all others
    size = F.floor(F.least(STEPS * F.log2(F.abs(v)), F.lit(float(1 << 39)))) + 2000 * STEPS
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("long")


def _part(v: Column, low: Column, high: Column) -> Column:
    """Where v stands between low and high, in PARTS equal parts."""
    return F.when(high > low, F.least(F.floor(PARTS * ((v - low) / (high - low))), F.lit(PARTS - 1))).otherwise(F.lit(0)).cast("long")


def _keys(by: Sequence[str]) -> list[str]:
    return [f"__g{i}" for i in range(len(by))]




def _joined(a: DataFrame, b: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """a and b's other columns; null keys are alike."""
    renamed = b.toDF(*(f"__r_{c}" if c in columns else c for c in b.columns))
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return (a.join(renamed, on, how) if columns else a.crossJoin(renamed)).drop(*(f"__r_{c}" for c in columns))


def _counts(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """Keys, __v, __cell and __n: how often each group has each value. Nulls are none."""
    keys = [F.col(c).alias(k) for c, k in zip(by, _keys(by))]
    rows = df.select(*keys, value.cast("double").alias("__v")).where("__v IS NOT NULL")
    return rows.groupBy(*_keys(by), "__v").agg(F.count(F.lit(1)).alias("__n")).withColumn("__cell", _cell(F.col("__v")))


def _cells(counts: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """keys, at, __low, __high, __m (rows) and __before (the group's rows in lower cells)."""
    made = counts.groupBy(*keys, at).agg(F.sum("__n").alias("__m"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("__before", F.coalesce(F.sum("__m").over(w), F.lit(0)))


def percentiles(df: DataFrame, by: Sequence[str], value: Column | str, levels: Mapping[str, float]) -> DataFrame:
    """A row for each group that has a value: by, and a column for each of the levels (0 to 1), interpolated between the two nearest.

    Equal to percentile() of Spark. Without by there is one row, of nulls where
    there are no values. Only the cells that hold a level's ranks are cut further.
    """
    value = F.col(value) if isinstance(value, str) else value
    keys = _keys(by)
    counts = _counts(df, by, value)
    cells = _cells(counts, keys, "__cell")
    sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    # the places of the levels among the sorted values, from 0
    places = [F.lit(float(p)) * (F.col("__all") - 1) for p in levels.values()]
    ranks = F.array_distinct(F.array(*(f(p).cast("long") for p in places for f in (F.floor, F.ceil))))
    wanted = _joined(cells, sizes, keys).withColumn("__rank", F.explode(ranks)).where("__rank >= __before AND __rank < __before + __m")
    wanted = wanted.groupBy(*keys, "__cell").agg(F.first("__low").alias("__low"), F.first("__high").alias("__high"), F.first("__before").alias("__start"), F.collect_set("__rank").alias("__ranks"))
    inside = _joined(counts, wanted, [*keys, "__cell"]).withColumn("__part", _part(F.col("__v"), F.col("__low"), F.col("__high"))).drop("__low", "__high")
    parts = _joined(_cells(inside, [*keys, "__cell"], "__part"), wanted.select(*keys, "__cell", "__start", "__ranks"), [*keys, "__cell"])
    parts = parts.withColumn("__start", F.col("__start") + F.col("__before"))
    parts = parts.withColumn("__ranks", F.filter("__ranks", lambda r: (r >= F.col("__start")) & (r < F.col("__start") + F.col("__m")))).where(F.size("__ranks") > 0)
    last = _joined(inside.select(*keys, "__cell", "__part", "__v", "__n"), parts.select(*keys, "__cell", "__part", "__start", "__ranks"), [*keys, "__cell", "__part"])
    w = Window.partitionBy(*keys, "__cell", "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("__start", F.col("__start") + F.coalesce(F.sum("__n").over(w), F.lit(0)))
    found = last.withColumn("__rank", F.explode("__ranks")).where("__rank >= __start AND __rank < __start + __n")
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("__rank", "__v"))).alias("__found"))
    found = _joined(found, sizes, keys) if keys else found.crossJoin(sizes)
    out = []
    for (name, _), place in zip(levels.items(), places):
        low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
        at = lambda r: F.try_element_at("__found", r)
        out.append(F.when(low == high, at(low)).otherwise((high - place) * at(low) + (place - low) * at(high)).alias(name))
    return found.select(*(F.col(k).alias(c) for k, c in zip(keys, by)), *out)


def with_percentiles(df: DataFrame, by: Sequence[str], value: Column | str, levels: Mapping[str, float], *aggregates: Column) -> DataFrame:
    """df by group with aggregates and percentiles(); groups without values have nulls."""
    made = df.groupBy(*by).agg(*aggregates)
    return _joined(made, percentiles(df, by, value, levels), list(by), "left")


def ranks(df: DataFrame, by: Sequence[str], value: Column | str) -> DataFrame:
    """A row for each group and value: by, value, before (rows of the group with less), n (with this value) and size (of the group).

    before + 1 is rank(), before / (size - 1) percent_rank() in ascending order.
    """
    value = F.col(value) if isinstance(value, str) else value
    keys = _keys(by)
    counts = _counts(df, by, value)
    cells = _cells(counts, keys, "__cell").select(*keys, "__cell", "__low", "__high", F.col("__before").alias("__start"))
    inside = _joined(counts, cells, [*keys, "__cell"]).withColumn("__part", _part(F.col("__v"), F.col("__low"), F.col("__high"))).drop("__low", "__high")
    parts = _cells(inside, [*keys, "__cell"], "__part").select(*keys, "__cell", "__part", "__before")
    both = _joined(inside, parts, [*keys, "__cell", "__part"])
    w = Window.partitionBy(*keys, "__cell", "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__start") + F.col("__before") + F.coalesce(F.sum("__n").over(w), F.lit(0))
    sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    out = _joined(both.withColumn("__less", before), sizes, keys)
    return out.select(*(F.col(k).alias(c) for k, c in zip(keys, by)), F.col("__v").alias("value"), F.col("__less").alias("before"), F.col("__n").alias("n"), F.col("__all").alias("size"))


def with_percent_rank(df: DataFrame, by: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """df with the percent rank of value within its group, in ascending order; rows without a value come first and count, as in Spark's order."""
    found = ranks(df, by, F.col(value))
    empty = df.groupBy(*by).agg(F.count_if(F.col(value).isNull()).alias("__nulls"))
    own = found.toDF(*by, "__value", "__before", "__n", "__size")
    rows = _joined(df.withColumn("__value", F.col(value).cast("double")), own, [*by, "__value"], "left")
    rows = _joined(rows, empty, list(by))
    size = F.coalesce("__size", F.lit(0)) + F.col("__nulls")
    # rows without a value are all first; a group of one row has rank 0
    below = F.when(F.col("__value").isNull(), 0).otherwise(F.col("__before") + F.col("__nulls"))
    rank = F.when(F.col("__value").isNull() | (size <= 1), 0.0).otherwise(below / (size - 1))
    return rows.withColumn(out, rank).drop("__value", "__before", "__n", "__size", "__nulls")


def top_share(df: DataFrame, by: str, value: str, counts: Sequence[int]) -> DataFrame:
    """One row: the per cent of the whole value that the first n groups have, for each n of counts.

    Ties go to the lesser group. Only as many groups as the largest n are ordered.
    """
    groups = df.groupBy(by).agg(F.sum(value).alias("value"))
    first = groups.orderBy(F.desc_nulls_last("value"), by).limit(max(counts))
    numbered = first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("value"), by)))
    sums = numbered.agg(*(F.sum(F.when(F.col("rank") <= n, F.col("value"))).cast("double").alias(f"top_{n}") for n in counts))
    total = df.agg(F.sum(value).cast("double").alias("__total"))
    return sums.crossJoin(total).select(*((100 * F.col(f"top_{n}") / F.col("__total")).alias(f"top_{n}") for n in counts))


def with_share(df: DataFrame, value: str, out: str = "share") -> DataFrame:
    """df with each row's per cent of the whole value, by one sum and no window over all rows."""
    total = df.agg(F.sum(value).cast("double").alias("__total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, 100 * F.col(value).cast("double") / F.col("__total")).drop("__total")
