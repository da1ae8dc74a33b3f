"""A whole report as one JSON document: named sections of differing shape in a given order.

Every section is one row of text when it comes to be put together: a single row
of figures, or a list that its own limit bounds. Lists that are nothing but
groups of the same rows are made in one pass and one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Groups:
    """A section of groups: the key's fields, which rows count, how many groups at most, and their order (value, contracts or key)."""

    fields: Mapping[str, Column]
    most: int
    where: Column | None = None
    order: str = "value"


def whole(value: Column) -> Column:
    """A sum as a whole number, 0 where there is nothing to sum."""
    return F.coalesce(F.round(F.sum(value), 0), F.lit(0)).cast("long")


def of_groups(df: DataFrame, sections: Mapping[str, Groups]) -> DataFrame:
    """section and json for each of the sections: the groups with their contracts and value.

    A row of df goes to each section that it counts in, and rows are summed by
    section and key before they are shuffled. Ties go by the key's text. The
    ranks need a section's first groups only, which Spark keeps from each task.
    """
    key = lambda g: F.to_json(F.struct(*(c.alias(n) for n, c in g.fields.items())), KEEP_NULLS)
    entry = lambda name, g: F.when(F.lit(True) if g.where is None else g.where, F.struct(F.lit(name).alias("section"), key(g).alias("key")))
    rows = df.select(F.inline(F.array_compact(F.array(*(entry(n, g) for n, g in sections.items())))), "value")
    sums = rows.groupBy("section", "key").agg(F.count(F.lit(1)).alias("contracts"), whole(F.col("value")).alias("value"))
    by = lambda name: F.col("section").isin(*[n for n, g in sections.items() if g.order == name])
    size = F.when(by("value"), F.col("value")).when(by("contracts"), F.col("contracts"))
    ranked = sums.withColumn("size", size).withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(F.desc_nulls_last("size"), "key")))
    most = F.create_map(*(x for n, g in sections.items() for x in (F.lit(n), F.lit(g.most))))
    kept = ranked.where(F.col("rank") <= max(g.most for g in sections.values())).where(F.col("rank") <= most[F.col("section")])
    said = F.concat(F.substring("key", F.lit(1), F.length("key") - 1), F.lit(',"contracts":'), "contracts", F.lit(',"value":'), "value", F.lit("}"))
    return _lists(kept.select("section", "rank", said.alias("said")))


def _lists(rows: DataFrame) -> DataFrame:
    lists = rows.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("rank", "said"))).alias("all"))
    return lists.select("section", F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["said"]), ","), F.lit("]")).alias("json"))


def of_rows(name: str, df: DataFrame, order: Sequence[Column], most: int) -> DataFrame:
    """A section that lists the first rows of df; no row for none."""
    first = df.orderBy(*order).limit(most)
    numbered = first.withColumn("__rank", F.row_number().over(Window.orderBy(*order)))  # over at most `most` rows
    return _lists(numbered.select(F.lit(name).alias("section"), F.col("__rank").alias("rank"), F.to_json(F.struct(*df.columns), KEEP_NULLS).alias("said")))


def of_figures(name: str, df: DataFrame) -> DataFrame:
    """A section that is one row's fields."""
    return df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns), KEEP_NULLS).alias("json"))


def document(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """One row, document: the sections in order; null stands for those that have no row, as lists without items have none."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    found = both.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("section", "json"))).alias("said"))
    entries = [F.concat(F.lit(f'"{n}":'), F.coalesce(F.try_element_at("said", F.lit(n)), F.lit("null"))) for n in order]
    return found.select(F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}")).alias("document"))
