"""The as-of join against a search row by row."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.asof import as_of

DAY0 = datetime(2020, 1, 1)


def at(day):
    return None if day is None else DAY0 + timedelta(days=day)


@pytest.mark.parametrize("slice", ["day", "month", "year"])
def test_as_of_is_a_search_for_the_newest_row_not_later(spark, slice):
    r = random.Random(3)
    left = [(i, r.choice([1, 1, 1, 2, 3, None]), r.choice([None, *range(-5, 900)]), "own") for i in range(500)]
    right = [(r.choice([1, 1, 2, 4, None]), r.choice([None, *range(0, 850, 7)]), r.choice([None, *range(40)])) for _ in range(200)]
    a = spark.createDataFrame([(i, k, at(d), o) for i, k, d, o in left], "id int, k int, t timestamp, v string").repartition(4)
    b = spark.createDataFrame([(k, at(d), v) for k, d, v in right], "k int, t timestamp, found int")
    out = as_of(a, b, ["k"], "t", "t", ["found"], [F.col("found")], slice)
    assert out.columns == ["id", "k", "t", "v", "found"]

    def newest(k, d):
        fit = [(e, -1 if v is None else v) for kk, e, v in right if k is not None and kk == k and d is not None and e is not None and e <= d]
        return None if not fit else (None if max(fit)[1] == -1 else max(fit)[1])

    assert sorted((x.id, x.found) for x in out.collect()) == [(i, newest(k, d)) for i, k, d, _ in left]


def test_a_hot_key_is_cut_by_time(spark):
    a = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2000).cast("int")).alias("t"))
    b = spark.range(40).select(F.lit(1).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 50 + 3).cast("int")).alias("s"), F.col("id").alias("v"))
    out = as_of(a, b, ["k"], "t", "s", ["v"])
    want = a.where("datediff(t, '2020-01-01') >= 3").agg(F.sum(F.expr("(datediff(t, '2020-01-01') - 3) div 50"))).first()[0]
    assert (out.count(), out.agg(F.sum("v")).first()[0]) == (20_000, want)
    specs = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [last(__found" in x.replace("#", " #")]
    assert all("__slice" in x for x in specs)


def test_empty_sides(spark):
    a, b = spark.createDataFrame([], "k int, t date"), spark.createDataFrame([], "k int, s date, v int")
    assert as_of(a, b, ["k"], "t", "s", ["v"]).count() == 0
    one = spark.createDataFrame([(1,)], "k int").withColumn("t", F.current_date())
    assert [x.v for x in as_of(one, b, ["k"], "t", "s", ["v"]).collect()] == [None]


@pytest.mark.parametrize("hot", [10, 100, 1000])
def test_hot_keys_cut_by_time_beside_whole_ones(spark, hot):
    r = random.Random(7)
    left = [(i, r.choice([1, 1, 1, 2, 3, 4, None]), r.choice([None, *range(-5, 900)])) for i in range(400)]
    right = [(r.choice([1, 1, 2, 4, None]), r.choice([None, *range(0, 850, 7)]), r.choice([None, *range(40)])) for _ in range(300)]
    a = spark.createDataFrame([(i, k, at(d)) for i, k, d in left], "id int, k int, t timestamp").repartition(4)
    b = spark.createDataFrame([(k, at(d), v) for k, d, v in right], "k int, s timestamp, found int").repartition(3)
    out = as_of(a, b, ["k"], "t", "s", ["found"], [F.col("found")], hot=hot)

    def newest(k, d):
        fit = [(e, -1 if v is None else v) for kk, e, v in right if kk is not None and kk == k and d is not None and e is not None and e <= d]
        return None if not fit or max(fit)[1] == -1 else max(fit)[1]

    assert sorted((x.id, x.found) for x in out.collect()) == [(i, newest(k, d)) for i, k, d in left]


def test_keys_of_few_rows_are_shuffled_once(spark):
    """No rows for what slices begin with, and the right rows go with the left ones: nothing else is shuffled but counts by hash."""
    a = spark.range(3000).select((F.col("id") % 1000).alias("k"), "id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("t"))
    b = a.select("k", F.col("t").alias("s"), F.col("id").alias("v"))
    out = as_of(a, b, ["k"], "t", "s", ["v"])
    rows = out.collect()
    assert len(rows) == 3000 and all(x.v is not None for x in rows)
    plan = out._jdf.queryExecution().executedPlan()
    out._jdf.queryExecution().executedPlan().executeCollect()
    final = plan.toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(__k0") == 1
