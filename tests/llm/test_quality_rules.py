import re

import duckdb
import numpy as np
import pytest

from tenderlake.llm import quality_rules as q
from tenderlake.llm import queries

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_figures_match_brute_force(spark):
    rows = queries.op1_quality_rules(spark, SF).collect()
    texts = dict(duckdb.execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_verdict_agrees_with_labels(spark):
    kept = {r.doc_id: r.kept for r in queries.op1_quality_rules(spark, "/root/testdata/sf0.1").collect()}
    labels = duckdb.execute("select doc_id, quality from '/root/testdata/sf0.1/labels.parquet'").fetchall()
    good = [kept[i] for i, y in labels if y == 1]
    bad = [kept[i] for i, y in labels if y == 0]
    assert np.mean(good) > 0.93 and np.mean(bad) < 0.1


def test_odd_rows(spark, odd, tables):
    rows = queries.op1_quality_rules(spark, tables(documents=odd)).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    for i, text in {r.doc_id: r.text for r in odd.collect()}.items():
        if i != 9:
            r = by_id[i]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
    assert by_id[9].n_repeat_words == 80_000
    assert all(r.kept is not None and r.base_failed is not None for r in rows)


def test_empty_table(spark, odd, tables):
    assert queries.op1_quality_rules(spark, tables(documents=odd.limit(0))).collect() == []


def test_many_distinct_words_use_relabelling():
    words = [b"%d" % i for i in range(20_000)]
    assert q.repeated_window_words(words) == 0
    assert q.repeated_window_words(words + words[100:110]) == 20


def test_estimate_tells_kinds_of_bad_texts():
    """Two kinds of bad texts that fail different rules, and rules that err now and then."""
    rng = np.random.default_rng(0)
    kind = rng.choice(3, 20_000, p=[0.85, 0.1, 0.05])
    chance = np.array([[0.005, 0.005, 0.01], [0.95, 0.02, 0.3], [0.02, 0.95, 0.5]])
    votes = np.where(rng.random((20_000, 3)) < chance[kind], -1, 1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = q.estimate(patterns.astype(float), counts.astype(float), list("abc"))
    weight = np.log(model.shares) + sum(np.log(np.array(model.chances)[:, j, :])[:, patterns[:, j] + 1].T for j in range(3))
    good = (np.exp(weight)[:, 0] / np.exp(weight).sum(1))[inverse.ravel()] > 0.5
    assert np.mean(good == (kind == 0)) > 0.97
    assert model.shares[0] == pytest.approx(0.85, abs=0.03)
    assert min(list(model.accuracy().values())[:2]) > 0.8


def posterior(model, patterns):
    weight = np.log(model.shares) + sum(np.log(np.array(model.chances)[:, j, :])[:, patterns[:, j].astype(int) + 1].T for j in range(patterns.shape[1]))
    return np.exp(weight)[:, 0] / np.exp(weight).sum(1)


def simulated(error, n=20_000, seed=1):
    """Votes of a family of three signs of one kind of bad text; the third is wrong on error of the good ones."""
    rng = np.random.default_rng(seed)
    bad = rng.random(n) < 0.1
    chance = np.where(bad[:, None], [0.95, 0.95, 0.6], [0.003, 0.003, error])
    votes = np.where(rng.random((n, 3)) < chance, -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return patterns.astype(float), counts.astype(float)


def test_a_weak_bad_vote_is_outvoted_and_the_corpus_tells_which_is_weak():
    model = q.estimate(*simulated(0.15), list("abc"), ["abc"])
    assert model.accuracy()["c"] < 0.9 < 0.98 < model.accuracy()["a"]
    assert model.chances[0][2][0] == pytest.approx(0.15, abs=0.02) and model.chances[1][2][0] == pytest.approx(0.6, abs=0.05)
    lone, pair, none = posterior(model, np.array([[1, 1, -1], [-1, -1, 1], [1, 1, 1]], float))
    assert lone > 0.9 and pair < 0.1 and none > 0.99
    better = q.estimate(*simulated(0.002), list("abc"), ["abc"])
    assert better.accuracy()["c"] > model.accuracy()["c"]
    assert posterior(better, np.array([[1, 1, -1]], float))[0] < lone


def test_two_weak_bad_votes_stay_and_one_strong_goes():
    """From counts of votes alone: two bad votes of signs that are often wrong keep a text, one of a sign that seldom is rejects it."""
    rng, names = np.random.default_rng(1), ["strong", "weak1", "weak2", "weak3"]
    bad = rng.random(40_000) < 0.2
    votes = np.where(rng.random((40_000, 4)) < np.where(bad[:, None], [0.98, 0.6, 0.6, 0.6], [0.001, 0.15, 0.15, 0.15]), -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = q.estimate(patterns.astype(float), counts.astype(float), names, [names])
    assert model.accuracy()["strong"] > 0.99 and all(0.75 < model.accuracy()[n] < 0.85 for n in names[1:])
    two_weak, one_strong = posterior(model, np.array([[1, -1, -1, 1], [-1, 1, 1, 1]], float))
    assert two_weak > 0.9 and one_strong < 0.25


def test_verdicts_differ_from_all_must_pass(spark):
    """On sf0.1 votes are outvoted, and labelled good texts are kept that all-must-pass rejects."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    features = q.written(q.with_features(docs, keep=["doc_id"]), "features")
    judged = q.judged(features, q.fit(features))
    passes = F.forall(F.array(*q.rules().values()), lambda v: v >= 0)
    got = judged.where("NOT base_failed").select("doc_id", "kept", passes.alias("passes")).toPandas()
    labels = duckdb.execute("select doc_id, quality from '/root/testdata/sf0.1/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    assert (got.kept != got.passes).sum() > 300
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.kept.mean() > 0.99 > 0.96 > good.passes.mean()
    assert bad.kept.mean() < 0.01


def test_letters_of_any_script_count():
    assert q.features_of("ÀÉ à Ж ж ß İ 中")[6:8] == (4, 3)
    assert q.features_of("Ab cD")[6:8] == (2, 2)


def test_only_kept_leaves_clashing_columns_alone(spark, prose):
    good = prose
    rows = [(1, good, 5, "x", True, "t"), (1, good, 5, "x", True, "t"), (None, good + " More.", None, None, None, None), (3, "bad", 1, "y", False, "u"), (4, None, 1, "y", False, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, quality string, kept boolean, __text string")
    kept = q.only_kept(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows[:3], key=str)
