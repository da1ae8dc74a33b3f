"""Ingest cycles: ranges from a watermark, their signals, and the state tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERLAP_DAYS = 45
ALARM_ROWS, ALARM_SHARE = 1000, 0.10


def ingest_range(watermark: date | None, until: date, overlap: int = OVERLAP_DAYS, start: date | None = None) -> tuple[date, date]:
    """The days to read. Without start it is overlap days before the watermark."""
    first = start or (watermark - timedelta(overlap) if watermark else None)
    if first is None:
        raise ValueError("without a watermark the first day has to be given")
    if overlap < 0 or first > until:
        raise ValueError("the range is reversed")
    return first, until


def in_range(column: str, first: date, last: date) -> Column:
    """Both days included; a plain range on the column, which reaches the scan."""
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last + timedelta(1)))


def cycle(inserted: DataFrame, seen: int, watermark: date | None, first: date, fact: str = "fact_on") -> DataFrame:
    """One row of a complete cycle's counts. inserted is append_new()'s result with the fact's date.

    recovered: inserted facts older than the watermark. short_window: new ids on
    the range's oldest day, a sign that the overlap is too short; changed_on_edge
    are new versions there, which is none.
    """
    edge = F.col(fact) == F.lit(first)
    late = F.col(fact) < F.lit(watermark) if watermark else F.lit(False)
    return inserted.agg(
        F.lit(seen).cast("long").alias("seen"), F.count(F.lit(1)).alias("inserted"), F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("changed"),
        F.count_if(late).alias("recovered"), F.count_if(edge & F.col("is_new")).alias("short_window"), F.count_if(edge & ~F.col("is_new")).alias("changed_on_edge"), F.max(fact).alias("last_fact"),
    ).withColumn("duplicates", F.col("seen") - F.col("inserted"))


def with_alarms(cycles: DataFrame) -> DataFrame:
    """cycles (dataset, finished_at, state, derived, seen, duplicates, ...) with two alarms.

    changed_everything: of many rows hardly any was known. almost_nothing: a
    derived range brought a tenth of the dataset's last complete cycle.
    """
    done = F.col("state") == "complete"
    w = Window.partitionBy("dataset").orderBy("finished_at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(done, F.col("seen")), True).over(w)
    out = cycles.withColumn("previous", before)
    everything = done & (F.col("seen") >= ALARM_ROWS) & (F.col("duplicates") < ALARM_SHARE * F.col("seen"))
    nothing = done & F.col("derived") & (F.col("previous") >= ALARM_ROWS) & (F.col("seen") < ALARM_SHARE * F.col("previous"))
    return out.withColumn("changed_everything", everything).withColumn("almost_nothing", F.coalesce(nothing, F.lit(False)))


def advanced(watermarks: DataFrame, reached: DataFrame) -> DataFrame:
    """Watermarks (dataset, fact_on, updated_at) after a cycle; they never go back."""
    both = watermarks.unionByName(reached)
    return both.groupBy("dataset").agg(F.max("fact_on").alias("fact_on"), F.max("updated_at").alias("updated_at"))


def novelties(known: DataFrame, found: DataFrame) -> DataFrame:
    """Fields outside the expected schema with their first and last sighting."""
    return known.unionByName(found).groupBy("dataset", "field").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def schema_check(declared: set[str], expected: set[str]) -> set[str]:
    """New fields. Missing ones are an error, before anything is read; computed platform columns do not count."""
    if missing := expected - declared:
        raise ValueError(f"fields are missing: {sorted(missing)}")
    return {f for f in declared - expected if not f.startswith(":@computed_region")}


def violations(cycles: DataFrame) -> DataFrame:
    """Rows of the cycle log that break its rules, with the rule's name."""
    rules = {
        "state": ~F.col("state").isin("complete", "failed", "running"), "failed_without_cause": (F.col("state") == "failed") & F.col("cause").isNull(),
        "negative_count": F.least("seen", "inserted", "duplicates") < 0, "sum": F.col("inserted") + F.col("duplicates") != F.col("seen"),
        "range": F.col("first") > F.col("last"),
    }
    broken = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))
    return cycles.select("*", F.explode(broken).alias("rule"))
