import hashlib

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tenderlake.llm import queries, secret_scan, simhash_dedup

SF = "/root/testdata/sf0.001"


def stage_by_stage(spark, docs, folder, path):
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
        kept.append(docs)
    return kept


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good, apart, clean, mixed, tokens = stage_by_stage(spark, docs, SF, tmp_path)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    verdict = {r.doc_id: r.kept for r in queries.op1_quality_rules(spark, SF).collect()}
    assert ids(good) == sorted(i for i, k in verdict.items() if k)
    assert all(df.columns == docs.columns for df in (good, apart, clean, mixed))
    groups = simhash_dedup.groups(good).collect()
    assert ids(apart) == sorted({r.component_id for r in groups})
    texts = {r.doc_id: r for r in apart.collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {i: (t := secret_scan.redacted(r.text), len(t)) for i, r in texts.items()}
    assert not any(secret_scan.find(r.text) for r in clean.collect())
    assert set(ids(mixed)) <= set(ids(clean)) and len(ids(mixed)) > len(set(ids(mixed)))
    made = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    said = {r.doc_id: hashlib.sha256(" ".join(map(str, made.encode(r.text, add_special_tokens=False).ids)).encode()).hexdigest() for r in clean.collect()}
    assert sorted((r.doc_id, r.ids_sha256) for r in tokens.collect()) == sorted((i, said[i]) for i in ids(mixed))
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, tokens.collect()))


def test_near_duplicates_keep_a_row_of_each_group(spark):
    """Ids may be missing or shared by different texts; what stays depends on neither partitions nor order."""
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(40)) for w in ("ant", "bee", "cat", "dog", "elk"))
    rows = [(None, a), (3, b), (5, b), (5, c), (None, c), (7, d), (7, e), (7, e), (None, e), (None, "x"), (None, "x"), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs.repartition(n), SF).collect()), key=str) for n in (1, 3)]
    assert kept[0] == kept[1]
    assert sorted((r[:2] for r in kept[0]), key=str) == sorted([(None, a), (3, b), (5, c), (7, d), (7, e), (None, "x"), (9, None)], key=str)
    alike = docs.drop("n_chars").withColumn("n_chars", F.lit(1).cast("long"))
    assert sorted((tuple(r)[:2] for r in corpus_pipeline.near_duplicates(spark, alike, SF).collect()), key=str) == sorted((r[:2] for r in kept[0]), key=str)


CLASHING = "target edge last epochs source_size n_words kept quality base_failed root first key bits ids spans bucket words __text __block __bucket __words __places __copy __copies __key0 __id __0 __1 text_1".split()


def test_odd_rows(spark, odd, tables, tmp_path):
    """Nulls, repeats, very long texts and extra columns of any name go through all stages unharmed."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", *(F.concat(F.lit(f"own {c} "), F.coalesce(F.col("source"), F.lit("-"))).alias(c) for c in CLASHING))
    kept = stage_by_stage(spark, docs, tables(documents=docs), tmp_path)
    assert all(df.columns == docs.columns for df in kept[:-1])
    rows = {tuple(r) for r in docs.drop("text", "n_chars").collect()}
    assert all({tuple(r) for r in df.drop("text", "n_chars").collect()} <= rows for df in kept[:-1])
    empty = stage_by_stage(spark, docs.limit(0), tables(documents=docs.limit(0)), tmp_path / "empty")
    assert all(df.count() == 0 for df in empty)


def test_each_stage_keeps_clashing_columns(spark, prose):
    good = prose
    names = [c for c in CLASHING if c != "text_1"]
    docs = spark.createDataFrame([(1, good, "en", "a", len(good), *names), (2, "wholly other words " + " ".join(w[::-1] for w in good.split()), "en", None, 1, *names)], ["doc_id", "text", "lang", "source", "n_chars", *names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(list(r)[5:] == names for r in out.collect()) and not out.isEmpty(), name


def test_registered():
    found = entry.queries()
    assert "pipeline" in found and sum(n.startswith("op") for n in found) >= 10
    assert set(entry.oracle_sql()) <= set(found)
