import re

import pytest

from tenderlake.llm import queries, source_mix

SF = "/root/testdata/sf0.01"


def brute_targets(sizes):
    """The sharing as told: all share by weight, those above their cap stop there, the rest share again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, left, free = {}, sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= 3 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 3 * sizes[s] for s in over}
        left, free = left - sum(3 * sizes[s] for s in over), free - over
    return out


@pytest.mark.parametrize("odd_rows", [False, True])
def test_mix(spark, odd, tables, odd_rows):
    folder = tables(documents=odd) if odd_rows else SF
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = queries.op5_source_mix(spark, folder).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, queries.op5_source_mix(spark, folder).collect()), key=str)
    size = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.source) for r in docs]
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id is not None) == sorted((d, n) for d, n, _ in size if d is not None)
    total = {}
    for _, n, s in size:
        total[s] = total.get(s, 0) + n
    want = brute_targets(total)
    source = {d: s for d, _, s in size}
    taken, longest = dict.fromkeys(total, 0), dict.fromkeys(total, 0)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in total:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1, s


def test_better_texts_are_taken_more_often(spark):
    """Efraimidis-Spirakis: of equally long texts those of weight 0.2 enter a fifth as often as those of weight 1, at small fractions."""
    rows = [(i, "word " * 10 if i % 2 else "w##d " * 10, "a") for i in range(8000)] + [(9000 + i, "w " * 40_000, "b") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = source_mix.mix(docs, weights=(1, 9)).where("doc_id < 8000").select("doc_id", "copies").collect()
    good, bad = (sum(r.copies for r in got if r.doc_id % 2 == k) for k in (1, 0))
    assert good + bad > 500 and bad < 0.35 * good


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "FEW", 3)
    monkeypatch.setattr(source_mix, "PARTS", 4)
    docs = spark.createDataFrame([(i % 150, f"{'w ' * (i % 7)}", "a" if i % 3 else None) for i in range(300)], "doc_id long, text string, source string")
    rows = source_mix.mix(docs).collect()
    by = {}
    for r in rows:
        at = by.setdefault((r.target, r.source_size), [0, 0])
        at[0] += r.taken
        at[1] += r.size
    assert len(rows) == 300 and all(abs(t - target) <= 4 and n == size for (target, size), (t, n) in by.items())


def test_empty_tables(spark, odd, tables):
    assert queries.op5_source_mix(spark, tables(documents=odd.limit(0))).collect() == []
    nothing = odd.where("doc_id IN (1, 2, 3)")
    assert {r.taken for r in queries.op5_source_mix(spark, tables(documents=nothing)).collect()} == {0}


@pytest.mark.parametrize("parts", [2, 7, 4096])
def test_taken_rows_match_a_walk_along_the_keys(spark, monkeypatch, parts):
    """Whole epochs, then row by row in the order of their keys while the target is nearer with the row than without; of alike rows any."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(source_mix, "FEW", 5)
    monkeypatch.setattr(source_mix, "PARTS", parts)
    rows = [(i if i % 11 else None, "w " * (i * i % 23) + "#" * (i % 5), (None, "a", "b", "b", "b", "c")[i % 6], 0.01 + (i % 10) / 10) for i in range(900)] + [(5, "w w", "b", 0.2)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double").repartition(5)
    keyed = docs.select("doc_id", "source", source_mix.n_words(F.col("text")).alias("size"), source_mix.sampling_key(F.col("doc_id"), F.col("text"), F.col("weight"), 7).alias("key"), F.concat(F.sha1("text"), F.col("weight").cast("string")).alias("t"))
    by = {}
    for r in keyed.collect():
        by.setdefault(r.source, []).append(r)
    want = {}
    target = brute_targets({s: sum(r["size"] for r in group) for s, group in by.items()})
    for s, group in by.items():
        total = sum(r["size"] for r in group)
        epochs = min(int(target[s] // total), 3)
        rest, at, places = target[s] - epochs * total, 0, {}
        for r in group:
            places.setdefault(r.key, []).append(r)
        going = rest > 0 and epochs < 3
        for key in sorted(places):
            for r in places[key]:
                going = going and at + r["size"] / 2 <= rest
                at += r["size"]
                k = (r.doc_id, s, r.t)
                want[k] = want.get(k, 0) + epochs + going
    got = docs.select("*", F.concat(F.sha1("text"), F.col("weight").cast("string")).alias("t"), F.col("weight").alias("w"))
    chosen = source_mix.repeated(got, quality="w").groupBy("doc_id", "source", "t").count().collect()
    assert {(r.doc_id, r.source, r.t): r["count"] for r in chosen} == {k: n for k, n in want.items() if n}


@pytest.mark.parametrize("stage", [False, True])
def test_the_edge_may_fall_among_alike_rows(spark, stage):
    """A source of 1,000 equal rows comes within one row of its target, and so does a hot row amid others."""
    from pyspark.sql import functions as F

    rows = [(1, "w " * 10, "a")] * 1000 + [(i, "w " * 10, "b") for i in range(1000)] + [(5, "w " * 7, "c")] * 900 + [(i, "w " * 3, "c") for i in range(600)] + [(9, "", "c")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    found = source_mix.mix(docs)
    assert found.count() == len(rows) and found.columns == ["doc_id", "size", "source_size", "target", "taken", "copies"]
    if stage:
        sums = source_mix.repeated(docs).groupBy("source").agg(F.sum(source_mix.n_words(F.col("text"))).alias("taken"))
        targets = {"a": None, "b": None, "c": None}
        for r in found.select("source_size", "target").distinct().collect():
            targets["c" if r.source_size == 8100 else "a" if r.target > 10_000 else "b"] = r.target
        got = {r.source: r.taken for r in sums.collect()}
        assert all(abs(got[s] - targets[s]) <= 7 for s in targets)
        return
    by = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n")).collect()
    assert len(by) == 3 and all(abs(r.taken - r.target) <= 5 for r in by)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, source_mix.mix(docs.repartition(3)).collect()))
