"""Report blocks over contracts and processes.

All blocks take DataFrames with the columns of normalize.contracts() and return
DataFrames; nothing is collected.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from . import orderstats


def rows() -> Column:
    """The number of rows."""
    return F.count(F.lit(1))


def money(c: Column | str) -> Column:
    """A sum that is 0 where there is nothing to sum, as a double: sums of decimals are exact before the cast."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("double")


def supplier() -> Column:
    """A supplier's identity as one value: pairs with a null count as well."""
    return F.struct("supplier_type", "supplier_number")


def real() -> Column:
    """Contracts of a supplier with a document."""
    return F.col("provisional") == F.lit(False)


def totals(df: DataFrame) -> DataFrame:
    """One row: dates, contracts, value, entities and identified suppliers."""
    return df.agg(F.min("signed_on").alias("first_day"), F.max("signed_on").alias("last_day"), rows().alias("contracts"), money("value").alias("value"), F.countDistinct("entity_id").alias("entities"), F.count_distinct(F.when(real(), supplier())).alias("suppliers"))


def coverage(df: DataFrame) -> DataFrame:
    """One row: how many contracts have what; over all of them, errata (is_errata) and impossible values included."""
    has = lambda c: F.col(c).isNotNull()
    count = lambda name, c: F.count_if(c).alias(name)
    wrong = F.coalesce("out_of_scale", F.lit(False))
    return df.agg(
        rows().alias("contracts"), count("with_value", has("value")), count("linked", has("process_id")), count("orphans", has("link_key") & ~has("process_id")),
        count("without_key", ~has("link_key")), count("without_supplier", ~has("supplier_number")), count("provisional", F.coalesce("provisional", F.lit(False))),
        count("without_department", ~has("department")), count("impossible", wrong), money(F.when(wrong, F.col("value"))).alias("impossible_value"),
        count("errata", F.col("is_errata")), money(F.when(F.col("is_errata"), F.col("value"))).alias("errata_value"),
    )


def part(name: str, condition: Column) -> list[Column]:
    """The contracts that meet a condition, and their value."""
    return [F.count_if(condition).alias(name), money(F.when(condition, F.col("value"))).alias(f"{name}_value")]


def identities(df: DataFrame) -> DataFrame:
    """One row: contracts and value by what is known of the supplier. Those of identified suppliers without a name count as identified too."""
    kinds = {"identified": real(), "ventures": F.col("provisional"), "unidentified": F.col("provisional").isNull(), "nameless": real() & V.is_sentinel(F.col("supplier_name"))}
    return df.agg(*(c for name, condition in kinds.items() for c in part(name, condition)))


def ranking(df: DataFrame, by: list[str], k: int, order: str = "value", ties: list[str] | None = None) -> DataFrame:
    """The k groups with most value (or contracts); ties by the group's columns."""
    out = df.groupBy(*by).agg(rows().alias("contracts"), money("value").alias("value"))
    return out.orderBy(F.desc_nulls_last(order), *(ties or by)).limit(k)


def by_modality(df: DataFrame, processes: DataFrame, k: int, default: str | None = None) -> DataFrame:
    """Contracts by their process's modality; with default, contracts without a process count under it."""
    kind = processes.select("process_id", "modality")
    both = df.join(kind, "process_id", "left" if default else "inner")
    if default:
        both = both.withColumn("modality", F.coalesce("modality", F.lit(default)))
    return ranking(both, ["modality"], k, "contracts")


def by_bucket(df: DataFrame, edges: tuple[float, ...]) -> DataFrame:
    return df.where("value IS NOT NULL").groupBy(V.bucket(F.col("value"), edges).alias("bucket")).agg(rows().alias("contracts"), money("value").alias("value"))


def largest(df: DataFrame, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("value"), "contract_id").limit(k)


def daily(df: DataFrame) -> DataFrame:
    return df.where("signed_on IS NOT NULL").groupBy("signed_on").agg(rows().alias("contracts"), money("value").alias("value"))


def spine(df: DataFrame, last: Column, days: int) -> DataFrame:
    """The last days up to last, a row each, days without contracts as 0. last is a one-row column of df's range."""
    span = df.agg(F.max(last).alias("end")).select(F.explode(F.sequence(F.date_sub("end", days - 1), F.col("end"))).alias("signed_on"))
    out = span.join(daily(df), "signed_on", "left")
    return out.select("signed_on", F.coalesce("contracts", F.lit(0)).alias("contracts"), F.coalesce("value", F.lit(0.0)).alias("value"))


def figures(df: DataFrame) -> DataFrame:
    """One row of a day or a period: counts, value, entities, suppliers, levels, median and mean."""
    counts = rows().alias("contracts"), money("value").alias("value"), F.countDistinct("entity_id").alias("entities"), F.count_distinct(F.when(real(), supplier())).alias("suppliers")
    return orderstats.with_percentiles(df, [], "value", {"median": 0.5}, *counts, F.avg(F.col("value").cast("double")).alias("mean"))


def period_pair(df: DataFrame, first: date, last: date) -> DataFrame:
    """Two rows, period now and before: the window and the equally long one just before it."""
    length = (last - first).days + 1
    label = F.when(F.col("signed_on").between(first, last), "now").when(F.col("signed_on").between(first - timedelta(length), first - timedelta(1)), "before")
    return df.withColumn("period", label).where("period IS NOT NULL").groupBy("period").agg(rows().alias("contracts"), money("value").alias("value"), F.countDistinct("entity_id").alias("entities"))


def comparable(first_ingested: Column, start: Column) -> Column:
    """Whether the previous period was wholly ingested."""
    return start >= first_ingested


def calendar_rollup(df: DataFrame, unit: str) -> DataFrame:
    """By day, week (from Monday) or month: counts, distinct entities and suppliers, first and last day with data."""
    start = F.trunc("signed_on", unit) if unit != "day" else F.col("signed_on")
    return df.where("signed_on IS NOT NULL").groupBy(start.alias("start")).agg(
        rows().alias("contracts"), money("value").alias("value"), F.countDistinct("entity_id").alias("entities"), F.count_distinct(F.when(real(), supplier())).alias("suppliers"),
        F.min("signed_on").alias("first_day"), F.max("signed_on").alias("last_day"),
    )


def top_of_buckets(df: DataFrame, k: int) -> DataFrame:
    """The k largest contracts of each day, week and month under one key. One pass: rows are exploded, not the input reread."""
    keys = F.array(*(F.concat(F.lit(p), F.date_format(d, "yyyy-MM-dd")) for p, d in (("d", F.col("signed_on")), ("s", F.trunc("signed_on", "week")), ("m", F.trunc("signed_on", "month")))))
    out = df.where("signed_on IS NOT NULL").select(F.explode(keys).alias("key"), "contract_id", F.col("value").cast("double").alias("value"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc_nulls_last("value"), "contract_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def representative_day(df: DataFrame, back: int = 60, floor: int = 300, share: float = 0.6) -> DataFrame:
    """The last day, within back days, with at least share of the median of days that have floor contracts; else the last day."""
    days = df.where("signed_on IS NOT NULL").groupBy("signed_on").agg(rows().alias("n"))
    days = days.withColumn("end", F.max("signed_on").over(Window.partitionBy())).where(F.col("signed_on") > F.date_sub("end", back))
    days = days.withColumn("median", F.percentile(F.when(F.col("n") >= floor, F.col("n")), 0.5).over(Window.partitionBy()))
    return days.agg(F.coalesce(F.max(F.when(F.col("n") >= share * F.col("median"), F.col("signed_on"))), F.max("end")).alias("day"))


def top_share(df: DataFrame, by: str, counts: tuple[int, ...]) -> DataFrame:
    """The share of value of the first n groups, for each n."""
    return orderstats.top_share(df, by, "value", counts)


def top_percent(df: DataFrame, percent: int = 1) -> DataFrame:
    """One row: the largest contracts, percent of a hundred of them, their value and its share. Ties change nothing.

    Values are counted by thousandths of their logarithm, at most some ten
    thousand groups; only the values of the one group with the cut are ordered.
    """
    step = F.when(F.col("value") > 0, F.floor(1000 * F.log10(F.col("value").cast("double")))).otherwise(F.lit(-(10**6)))
    valued = df.where("value IS NOT NULL").select("value", step.alias("step"))
    total = valued.agg(rows().alias("all"), F.sum("value").alias("sum")).withColumn("take", F.greatest(F.lit(1), F.floor(F.col("all") * percent / 100)))
    steps = valued.groupBy("step").agg(rows().alias("n"), F.sum("value").alias("v"))
    steps = steps.withColumn("before", F.sum("n").over(Window.orderBy(F.desc("step"))) - F.col("n")).crossJoin(F.broadcast(total))
    whole = steps.where("before + n <= take").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    cut = steps.where("before < take AND before + n > take").select("step", "before", "take")
    inside = valued.join(F.broadcast(cut), "step").groupBy("value").agg(rows().alias("n"), F.first("before").alias("before"), F.first("take").alias("take"))
    inside = inside.withColumn("start", F.col("before") + F.sum("n").over(Window.orderBy(F.desc("value"))) - F.col("n"))
    used = F.greatest(F.lit(0), F.least("n", F.col("take") - F.col("start")))
    part = inside.select(used.cast("long").alias("n"), (used * F.col("value")).alias("v")).agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    both = whole.unionByName(part).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("contracts"), F.coalesce(F.sum("v"), F.lit(0)).cast("double").alias("value"))
    return both.crossJoin(total).select("contracts", "value", (100 * F.col("value") / F.col("sum").cast("double")).alias("share"))


def largest_share(df: DataFrame, minimums: tuple[int, ...]) -> DataFrame:
    """For each minimum of contracts, entities that have it and how many of them buy over half from one supplier."""
    pairs = df.where(real()).groupBy("entity_id", "supplier_type", "supplier_number").agg(rows().alias("n"))
    entities = pairs.groupBy("entity_id").agg(F.sum("n").alias("n"), (F.max("n") / F.sum("n")).alias("share"))
    least = entities.select("*", F.explode(F.array(*map(F.lit, minimums))).alias("minimum")).where("n >= minimum")
    return least.groupBy("minimum").agg(rows().alias("entities"), F.count_if(F.col("share") > 0.5).alias("concentrated"), F.avg("share").alias("mean_share"))


def before_after(df: DataFrame, by: str, cut: date) -> DataFrame:
    """Contracts by group before and from a day on."""
    day = F.col("signed_on")
    return df.groupBy(by).agg(F.count_if(day < F.lit(cut)).alias("before"), F.count_if(day >= F.lit(cut)).alias("after"))


def delays(df: DataFrame, processes: DataFrame) -> DataFrame:
    """df with days, from publication to signature."""
    return df.join(processes.select("process_id", "published_on", "modality"), "process_id").withColumn("days", F.date_diff("signed_on", "published_on")).where("days IS NOT NULL")


def quintile_breaks(df: DataFrame, value: str, parts: int = 5) -> DataFrame:
    """The values at the places round(i * n / parts) of the sorted ones, without repeats. df is a small aggregate."""
    sorted_values = df.agg(F.array_sort(F.collect_list(value)).alias("v"))
    places = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.bround(i * F.size("v") / parts, 0).cast("int"))
    return sorted_values.select(F.array_distinct(F.transform(places, lambda p: F.element_at("v", F.least(p + 1, F.size("v"))))).alias("breaks"))


def against_last_week(days: DataFrame) -> DataFrame:
    """daily() with the contracts of the same weekday a week before, 0 where there were none, and the change in per cent."""
    before = days.select(F.date_add("signed_on", 7).alias("signed_on"), F.col("contracts").alias("before"))
    out = days.join(before, "signed_on", "left").withColumn("before", F.coalesce("before", F.lit(0)))
    return out.withColumn("change", V.variation(F.col("contracts"), F.col("before")))


def against_previous(periods: DataFrame) -> DataFrame:
    """calendar_rollup() of weeks or months with the previous period that has contracts, the change and its trend. Windows run over periods."""
    before = F.lag("contracts").over(Window.orderBy("start"))
    out = periods.withColumn("before", before).withColumn("change", V.variation(F.col("contracts"), F.col("before")))
    return out.withColumn("trend", V.trend(F.col("change"), 0.05))


def missing_days(periods: DataFrame, unit: str) -> DataFrame:
    """Calendar days of each period before its first and after its last day with data."""
    end = F.last_day("start") if unit == "month" else F.date_add("start", 6)
    return periods.select("start", F.date_diff("first_day", "start").alias("at_start"), F.date_diff(end, "last_day").alias("at_end"))


def same_kind_of_day(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """daily() with comparable: whether the day and the one a week before are equally business days or not."""
    kind = F.broadcast(calendar.select(F.col("day"), F.col("business")))
    now = days.join(kind.withColumnRenamed("day", "signed_on"), "signed_on")
    then = kind.select(F.date_add("day", 7).alias("signed_on"), F.col("business").alias("__then"))
    return now.join(then, "signed_on", "left").withColumn("comparable", F.col("business").eqNullSafe(F.col("__then"))).drop("__then")


def skewed_mean(figures: DataFrame, times: float = 3.0) -> DataFrame:
    """figures() with note: whether the mean is so many times the median that it says little."""
    return figures.withColumn("note", F.coalesce(F.col("mean") >= times * F.col("median"), F.lit(False)))
