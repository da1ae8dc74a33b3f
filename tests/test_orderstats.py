"""Percentiles and ranks by cells against Spark's own, which hold or sort whole groups."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenderlake.operators import orderstats

LEVELS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def rows(r):
    """Groups of very different sizes and kinds of value; null groups and values, one group with a third of all rows."""
    kinds = [lambda: r.gauss(0, 1), lambda: 10 ** r.uniform(-300, 300), lambda: -(10 ** r.uniform(-3, 15)), lambda: float(r.randint(-3, 3)), lambda: 5.0, lambda: 1e9 + r.random() * 1e-5, lambda: None]
    out = [(k, kinds[k]()) for k in range(len(kinds)) for _ in range(r.choice([1, 2, 3, 10, 200]))]
    out += [(99, r.choice(kinds[:4])()) for _ in range(1500)] + [(None, r.random()) for _ in range(11)] + [(50, None), (50, 1.0), (51, math.inf), (51, -math.inf), (51, 0.0)]
    return out


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(4)
    return spark.createDataFrame(rows(r), "g int, v double").repartition(5).cache()


@pytest.mark.parametrize("by", [["g"], []])
def test_percentiles_equal_sparks(data, by):
    found = orderstats.with_percentiles(data, by, "v", LEVELS, F.count(F.lit(1)).alias("rows"))
    own = data.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *(F.percentile("v", p).alias(n) for n, p in LEVELS.items()))
    key = lambda x: str(x[:2])
    for a, b in zip(sorted(map(tuple, found.select(*own.columns).collect()), key=key), sorted(map(tuple, own.collect()), key=key), strict=True):
        assert a[: len(by) + 1] == b[: len(by) + 1]
        for x, y in zip(a[len(by) + 1 :], b[len(by) + 1 :]):
            assert x == y or (x is not None and y is not None and (math.isnan(x) and math.isnan(y) or math.isclose(x, y, rel_tol=1e-12)))


def test_one_giant_group(spark):
    """A group of 200,000 rows, a third of them one value: no operator of the plan has the group or its values whole."""
    big = spark.range(200_000).select((F.col("id") % 1).alias("g"), F.when(F.col("id") % 3 == 0, 7.5).otherwise((F.col("id") * 7919 % 100_003) / 10).alias("v"))
    found = orderstats.percentiles(big, ["g"], "v", LEVELS)
    assert tuple(found.first())[1:] == tuple(big.agg(*(F.percentile("v", p) for p in LEVELS.values())).first())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
    # windows are over a group's cells, a cell's parts and a part's values, never over a group's rows
    specs = [line for line in plan.splitlines() if "Window [" in line]
    assert len(specs) >= 3 and all("__cell" in s for s in specs)


def test_percent_rank_equals_sparks(data):
    found = orderstats.with_percent_rank(data, ["g"], "v").select("g", "v", F.round("rank", 12).alias("rank"))
    own = data.withColumn("rank", F.round(F.percent_rank().over(Window.partitionBy("g").orderBy("v")), 12))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, own.collect()), key=str)


def test_ranks_of_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None)], "g string, v double")
    assert sorted(map(tuple, orderstats.ranks(df, ["g"], "v").collect())) == [("a", 1.0, 0, 2, 3), ("a", 3.0, 2, 1, 3), ("b", 2.0, 0, 1, 1)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "g int, v double")
    assert orderstats.percentiles(none, ["g"], "v", LEVELS).count() == 0
    assert [tuple(x) for x in orderstats.with_percentiles(none, [], "v", {"p": 0.5}, F.count(F.lit(1)).alias("n")).collect()] == [(0, None)]
    assert orderstats.with_percent_rank(none, ["g"], "v").count() == 0


def test_top_share_and_share(spark):
    df = spark.createDataFrame([("a", 6), ("b", 3), ("c", 1), ("c", None)], "g string, v long")
    assert tuple(orderstats.top_share(df, "g", "v", (1, 2, 9)).first()) == (60.0, 90.0, 100.0)
    assert [x.share for x in orderstats.with_share(df, "v").orderBy("g", F.desc("v")).collect()] == [60.0, 30.0, 10.0, None]
