"""The append-only raw layer: identity, content hashes, versions and re-ingestion."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _canonical(text: str) -> tuple[str | None, str | None]:
    """The canonical form of a text, or what keeps it from having one."""

    def refuse(name: str):
        raise ValueError(name)

    try:
        # whole numbers of any length stay as they are, and 1.0 is another number than 1
        said = json.loads(text, parse_constant=refuse)
    except (ValueError, RecursionError) as e:
        return None, "number is not finite" if str(e) in ("NaN", "Infinity", "-Infinity") else "not JSON"
    if not isinstance(said, dict):
        return None, "not an object"
    try:
        return json.dumps({k: v for k, v in said.items() if not k.startswith(":")}, sort_keys=True, ensure_ascii=False, allow_nan=False, separators=(",", ":")), None
    except ValueError:  # a literal like 1e999
        return None, "number is not finite"
    except RecursionError:
        return None, "not JSON"


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("problem", T.StringType())]))
def _forms(content: pd.Series) -> pd.DataFrame:
    made = [(None, None) if c is None else _canonical(c) for c in content]
    return pd.DataFrame(made, columns=["text", "problem"], dtype=object)


def canonical(content: Column) -> Column:
    """A JSON document with sorted keys on all levels and without the platform's own (those from a colon on).

    Values keep their types and whole numbers all their digits: 1, 1.0 and "1"
    are different contents. Of a key said twice the last counts. A text that is
    no JSON object, or holds a number that is not finite, has no canonical form.
    A document is read once, in time near its length, by Arrow batches.
    """
    return _forms(content)["text"]


def content_problem(content: Column) -> Column:
    """Why a content has no canonical form: not JSON, not an object, number is not finite; null where it has one or is null."""
    return _forms(content)["problem"]


def content_hash(content: Column) -> Column:
    """The hash of the canonical form; of the text itself, marked as such, where there is none, so that it too is known again."""
    return F.sha2(F.coalesce(canonical(content), F.concat(F.lit("no object: "), content)), 256)


def identity(*fields: Column) -> Column:
    """The fields joined by a bar up to the first blank one; null where the first is blank."""
    clean = [F.nullif(F.trim(f), F.lit("")) for f in fields]
    out, alive = clean[0], F.lit(True)
    for f in clean[1:]:
        alive = alive & f.isNotNull()
        out = F.when(alive, F.concat(out, F.lit("|"), f)).otherwise(out)
    return out


def identity_skipping(*fields: Column) -> Column:
    """The same, but a blank field after the first is skipped instead of ending it; alike for two fields."""
    clean = [F.nullif(F.trim(f), F.lit("")) for f in fields]
    return F.when(clean[0].isNotNull(), F.concat_ws("|", *clean))


def ranked(df: DataFrame, keys: list[str], order: list[Column], out: str = "version") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. Spark filters before it shuffles (WindowGroupLimit)."""
    return ranked(df, keys, order, "__n").where("__n = 1").drop("__n")


def append_new(existing: DataFrame, incoming: DataFrame, key: list[str], id_column: str) -> DataFrame:
    """Rows of incoming whose key is new, once each, with is_new: whether even their id is.

    The rest of an existing id are changed versions.
    """
    fresh = incoming.dropDuplicates(key).join(existing.select(*key), key, "left_anti")
    known = existing.select(id_column).distinct().withColumn("__known", F.lit(True))
    return fresh.join(known, id_column, "left").withColumn("is_new", F.col("__known").isNull()).drop("__known")


def changed_fields(df: DataFrame, keys: list[str], order: list[Column], content: str) -> DataFrame:
    """A row for each field that differs between the newest version of a key and the one before: field, before, after."""
    w = Window.partitionBy(*keys).orderBy(*order)
    both = df.withColumn("__n", F.row_number().over(w)).withColumn("__old", F.lead(content).over(w)).where("__n = 1 AND __old IS NOT NULL")
    now, old = F.from_json(content, "map<string,string>"), F.from_json("__old", "map<string,string>")
    both = both.withColumn("__now", now).withColumn("__then", old).withColumn("field", F.explode(F.array_union(F.map_keys("__now"), F.map_keys("__then"))))
    both = both.withColumn("before", F.col("__then")[F.col("field")]).withColumn("after", F.col("__now")[F.col("field")])
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select(*keys, "field", "before", "after")


def first_and_last(df: DataFrame, keys: list[str], at: list[str], value: str) -> DataFrame:
    """versions, first and last value of each key; the order is by the columns at. Partial aggregates, no sort."""
    order = F.struct(*at)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"), F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))


def histogram(df: DataFrame, keys: list[str], distinct: str | None = None) -> DataFrame:
    """How many keys have how many rows (or different values): a count of counts."""
    n = F.countDistinct(distinct) if distinct else F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.alias("rows")).groupBy("rows").agg(F.count(F.lit(1)).alias("keys"))


def rekeyed(df: DataFrame, new_key: Column, key: str, order: list[Column]) -> DataFrame:
    """Rows under a new key, collapsed to the latest of each key and content hash."""
    return latest(df.withColumn(key, new_key), [key, "hash"], order)


def rekey_matches(origin: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """One row: rows and keys on both sides and whether no key was lost."""
    a = origin.agg(F.count(F.lit(1)).alias("origin_rows"), F.countDistinct(key).alias("origin_keys"))
    b = made.agg(F.count(F.lit(1)).alias("made_rows"), F.countDistinct(key).alias("made_keys"))
    return a.crossJoin(b).withColumn("matches", F.col("made_keys") >= F.col("origin_keys"))


def numeric_changes(df: DataFrame, keys: list[str], order: list[Column], content: str, fields: list[str]) -> DataFrame:
    """Each numeric field that differs between a key's newest version and the one before, with after by before.

    Text that is no number counts as none; so does a former 0 for the ratio.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    both = df.withColumn("__n", F.row_number().over(w)).withColumn("__old", F.lead(content).over(w)).where("__n = 1 AND __old IS NOT NULL")
    number = lambda c, f: F.get_json_object(c, f"$.{f}").try_cast("double")
    rows = F.array(*(F.struct(F.lit(f).alias("field"), number(F.col("__old"), f).alias("before"), number(F.col(content), f).alias("after")) for f in fields))
    out = both.select(*keys, F.inline(rows)).where("before IS NOT NULL AND after IS NOT NULL AND before <> after")
    return out.withColumn("ratio", F.when(F.col("before") != 0, F.col("after") / F.col("before")))


def format_verdicts(df: DataFrame, keys: list[str], order: list[Column], content: str, field: str) -> DataFrame:
    """How a field's text changed from the version before to the newest: same, only format (equal as a number), value, appeared or vanished."""
    w = Window.partitionBy(*keys).orderBy(*order)
    both = df.withColumn("__n", F.row_number().over(w)).withColumn("__has", F.lead(F.lit(1)).over(w)).withColumn("__old", F.lead(content).over(w)).where("__n = 1 AND __has = 1")
    now, old = F.get_json_object(content, f"$.{field}"), F.get_json_object("__old", f"$.{field}")
    verdict = (
        F.when(now.eqNullSafe(old), "same").when(old.isNull(), "appeared").when(now.isNull(), "vanished")
        .when(now.try_cast("decimal(38,6)") == old.try_cast("decimal(38,6)"), "format").otherwise("value")
    )
    return both.select(*keys, verdict.alias("verdict"))


def repeated_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n keys, in order, that have several rows, and how many."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").orderBy(key).limit(n)
