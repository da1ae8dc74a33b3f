"""Typing errors by powers of ten, impossible values and what may be published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import orderstats
from .raw import latest, ranked


def power_of_ten(ratio: Column) -> Column:
    """How many zeros too many: the whole power of ten, 2 or more, that ratio is within a thousandth of; null for others."""
    zeros = F.round(F.log10(ratio))
    near = F.abs(ratio / F.pow(F.lit(10.0), zeros) - 1) < 0.001
    return F.when((ratio >= 100) & near, zeros.cast("int"))


def comparable() -> Column:
    """Whether a snapshot is awarded with both amounts."""
    return F.coalesce(F.col("awarded") & F.col("award").isNotNull() & (F.col("base") > 0), F.lit(False))


def with_ratio(snapshots: DataFrame) -> DataFrame:
    """Snapshots with ratio, the award by the budget."""
    return snapshots.withColumn("ratio", F.col("award").cast("double") / F.col("base").cast("double"))


def budget_ratios(snapshots: DataFrame, order: list[Column]) -> DataFrame:
    """Each process's latest snapshot among those awarded with both amounts, and ratio, the award by the budget.

    The filter comes first: it is the latest that qualifies, not the latest.
    """
    return with_ratio(latest(snapshots.where(comparable()), ["process_id"], order))


def ends(snapshots: DataFrame, order: list[Column]) -> DataFrame:
    """Each process's latest snapshot and its latest comparable() one, with is_latest and is_comparable; often they are the same row.

    Rows go to their process first and are sorted there: a task sorts a
    partition of the shuffle, whose size the session sets, and not its whole
    split of the input, of which little would be left out.
    """
    rows = snapshots.withColumn("is_comparable", comparable()).repartition("process_id")
    few = latest(rows, ["process_id", "is_comparable"], order)
    return ranked(few, ["process_id"], order, "__n").withColumn("is_latest", F.col("__n") == 1).drop("__n").where("is_latest OR is_comparable")


def out_of_proportion(ratios: DataFrame) -> DataFrame:
    """The rows of budget_ratios() whose award is a power of ten above their budget, with zeros."""
    return ratios.withColumn("zeros", power_of_ten(F.col("ratio"))).where("zeros IS NOT NULL")


def errata(snapshots: DataFrame, order: list[Column]) -> DataFrame:
    """Processes whose award is a power of ten above their budget, with zeros."""
    return out_of_proportion(budget_ratios(snapshots, order))


def publishable(contracts: DataFrame, errata_set: DataFrame) -> DataFrame:
    """Contracts without those of errata; contracts without a process stay."""
    return contracts.join(errata_set.select("process_id"), "process_id", "left_anti")


def in_scale(df: DataFrame) -> DataFrame:
    """All but impossible values; rows without a value stay."""
    return df.where(~F.coalesce("out_of_scale", F.lit(False)))


def flagged(contracts: DataFrame, errata_set: DataFrame, flag: str = "is_errata") -> DataFrame:
    return contracts.join(errata_set.select("process_id", F.lit(True).alias(flag)), "process_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def bands(df: DataFrame, value: str, edges: tuple[float, ...]) -> DataFrame:
    """Rows by band of value and their share in per cent; the total is summed over the bands, not over rows."""
    from ..functions.values import bucket

    out = df.groupBy(bucket(F.col(value), edges).alias("band")).agg(F.count(F.lit(1)).alias("rows"))
    return orderstats.with_share(out, "rows")


def thousand_times(contracts: DataFrame) -> DataFrame:
    """Pairs of one entity and supplier whose values differ by a factor of exactly 1000: contract_id has the smaller, other_id the larger."""
    a = contracts.where("value > 0").select("entity_id", "contract_id", "value", "supplier_number", (F.col("value") * 1000).alias("large"))
    b = a.select(F.col("entity_id").alias("e"), F.col("contract_id").alias("other_id"), F.col("value").alias("v"), F.col("supplier_number").alias("s"))
    on = (a["entity_id"] == b["e"]) & (a["large"] == b["v"]) & a["supplier_number"].eqNullSafe(b["s"]) & (a["contract_id"] != b["other_id"])
    return a.join(b, on).select("entity_id", "contract_id", "other_id", "value")


def ghosts(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents without children."""
    return parents.join(children.select(key).distinct(), key, "left_anti")


def stored_against_real(parents: DataFrame, children: DataFrame, key: str, stored: str) -> DataFrame:
    """Parents whose stored count is not their number of children."""
    real = children.groupBy(key).agg(F.count(F.lit(1)).alias("real"))
    return parents.join(real, key, "left").withColumn("real", F.coalesce("real", F.lit(0))).where(F.col(stored) != F.col("real"))


def completeness(df: DataFrame, columns: list[str], sentinels: tuple[str, ...]) -> DataFrame:
    """field, rows and usable values of each column, in one pass."""
    from ..functions.values import usable

    counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(usable(F.col(c).cast("string"), sentinels)).alias(c) for c in columns))
    return counts.select("rows", F.explode(F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns))).alias("field", "usable")).select("field", "rows", "usable")


# What a field says when nothing is known, in capitals.
NOTHING = ("NO DEFINIDO", "NO APLICA", "NO DEFINIDA", "SIN DESCRIPCION", "N/A", "NA", "NULL", "NINGUNO", "")


def says_something(value: Column) -> Column:
    """Whether a field's text is more than blank, a word for nothing or a zero."""
    text = F.trim(value)
    return F.coalesce(~F.upper(text).isin(*NOTHING) & ~text.rlike("^0([.,]0+)?$"), F.lit(False))


def by_story(documents: DataFrame, content: str, stories: Mapping[str, Sequence[str]], example: int = 28) -> DataFrame:
    """story, field, usable, rows, percent and an example for the fields that each story needs, of JSON documents.

    Every document is parsed once and all fields are counted in one pass: a field
    that no document has counts 0. The example is the greatest usable text, cut.
    """
    fields = sorted({f for fs in stories.values() for f in fs})
    parsed = documents.select(F.from_json(content, "map<string,string>").alias("m"))
    value = {f: F.try_element_at("m", F.lit(f)) for f in fields}
    places = {f: i for i, f in enumerate(fields)}
    counts = parsed.agg(F.count(F.lit(1)).alias("rows"), *(c for f in fields for c in (F.count_if(says_something(value[f])).alias(f"n{places[f]}"), F.max(F.when(says_something(value[f]), value[f])).alias(f"m{places[f]}"))))
    rows = F.array(*(F.struct(F.lit(s).alias("story"), F.lit(f).alias("field"), F.col(f"n{places[f]}").alias("usable"), F.left(F.col(f"m{places[f]}"), F.lit(example)).alias("example")) for s, fs in stories.items() for f in fs))
    out = counts.select("rows", F.inline(rows))
    return out.withColumn("percent", F.round(100.0 * F.col("usable") / F.when(F.col("rows") > 0, F.col("rows")), 1))


def keys_seen(df: DataFrame, content: str) -> DataFrame:
    """The keys of JSON documents: key, rows and how many have a value."""
    pairs = df.select(F.explode(F.from_json(content, "map<string,string>")).alias("key", "value"))
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("with_value"))
