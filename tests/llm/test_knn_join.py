import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import knn_join, queries

SF = "/root/testdata/sf0.01"


def brute(rows, step=50, k=5):
    """(query, rank, other, score) by comparing each query with every row."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_matches_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op2_knn_join(spark, SF).collect())) == brute(rows)


def test_odd_rows(spark, tables):
    rng = random.Random(2)
    some = [[rng.choice((-0.5, 0.25, 0.5)) for _ in range(4)] for _ in range(12)]
    rows = [(i, rng.choice(some)) for i in range(400)]  # many ties and copies
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0]), (600, [float("nan")] * 4), (650, [float("inf")] * 4), (None, some[0]), (700, [0.5, 0.5]), (701, [2e5] * 4)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, rank int, vector int")
    folder = tables(embeddings=df)
    assert sorted(map(tuple, queries.op2_knn_join(spark, folder).collect())) == brute(rows)
    few = tables(embeddings=df.where("vec_id IN (0, 1, 2)"))
    assert sorted(map(tuple, queries.op2_knn_join(spark, few).collect())) == brute(rows[:3])
    for none in (df.limit(0), df.where("vec_id = 0"), df.where("vec_id = 1")):
        assert queries.op2_knn_join(spark, tables(embeddings=none)).collect() == []


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_many_groups_and_chunks(spark, spread):
    """Clustered data with small groups and chunks: bounds exclude rows, results stay exact."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(8, 6)) * 3
    x = np.floor(256 * (centre[rng.integers(0, 8, 1500)] + spread * rng.normal(size=(1500, 6))))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    got = knn_join.top_k(df, F.col("vec_id") % 10 == 0, pivots=16, group=8, chunk=100)
    assert sorted(map(tuple, got.collect())) == brute([(i, (v / 256).tolist()) for i, v in enumerate(x)], step=10)


def test_repeated_rows_and_scores_that_are_too_large(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [5.0, 1.0]), (1, [5.0, 1.0]), (2, [4.0, 6.0]), (3, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = [tuple(r) for r in knn_join.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    # the alike rows of query 0 are one query; both its vectors share the five places
    assert got == [(0, 1, 2, 6), (0, 2, 1, 5), (0, 3, 1, 5), (0, 4, 2, 4), (0, 5, 3, 3)]
    with pytest.raises(ValueError, match="63 bits"):
        knn_join.top_k(spark.createDataFrame([(0, [4e9]), (1, [4e9])], "vec_id long, vector array<double>"), F.col("vec_id") == 0)
