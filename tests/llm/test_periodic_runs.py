import hashlib
import random

import numpy as np
import pytest

from tenderlake.llm import periodic_runs, queries


def brute(words, least, exponent):
    """All runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, z, q) for (s, z), q in found.items())


def made(r):
    """A sequence with repeats, repeats of repeats and copies of them."""
    k, t = r.choice([1, 2, 2, 3]), []
    base = [r.randrange(k) for _ in range(r.randint(0, 12))]
    for _ in range(r.randint(0, 6)):
        kind = r.random()
        if kind < 0.4:
            t += [r.randrange(k) for _ in range(r.randint(0, 10))]
        elif kind < 0.7:
            t += base * r.randint(1, 6)
        elif t:
            a = r.randrange(len(t))
            t += t[a : a + r.randint(1, 12)] * r.randint(1, 5)
    return t[:200]


def test_runs_are_those_of_brute_force():
    r, n = random.Random(1), 0
    for _ in range(800):
        texts, least = [made(r) for _ in range(r.randint(1, 4))], r.choice([3, 6, 9, 12, 24])
        for t, found in zip(texts, periodic_runs.all_runs([np.array(t, np.int64) for t in texts], least)):
            assert found == brute(t, least, 3)
            n += len(found)
    assert n > 1000


def test_longest_previous_factors_and_blocks():
    r = random.Random(2)
    for _ in range(200):
        t = made(r)
        if not t:
            continue
        names = periodic_runs.Names(np.array(t, np.int64), np.array([len(t)]))
        array = names.array.tolist()
        assert array == sorted(range(len(t)), key=lambda i: t[i:])
        common = lambda a, b: next((k for k in range(len(t) - max(a, b)) if t[a + k] != t[b + k]), len(t) - max(a, b))
        lcp = [0] + [common(a, b) for a, b in zip(array, array[1:])]
        longest, source = periodic_runs.previous_factors(array, lcp)
        assert longest == [max([common(i, j) for j in range(i)], default=0) for i in range(len(t))]
        assert all(n == 0 or (s < i and common(s, i) == n) for i, (n, s) in enumerate(zip(longest, source)))


def test_runs_inside_blocks_are_copied():
    unit = [0] * 30 + [1]
    text = np.array(unit * 5 + [2, 3] + unit * 5, np.int64)
    found = periodic_runs.all_runs([text])[0]
    assert found == brute(text.tolist(), 24, 3)
    assert sum(q == 1 for _, _, q in found) == 10 and sum(q == 31 for _, _, q in found) == 2


def test_best_and_kept():
    assert periodic_runs.best([]) is None
    assert periodic_runs.best([(9, 30, 10), (4, 24, 8), (0, 24, 8)]) == (0, 24, 8)
    words = [str(i) for i in range(40)]
    assert periodic_runs.kept(words, [(2, 30, 10), (20, 12, 4)]) == words[:12] + words[32:]


def expected(doc_id, text):
    words = periodic_runs.rewritten(periodic_runs._WORD.findall(text or ""), doc_id)
    found = brute(words, 24, 3)
    gone = {i for s, z, q in found for i in range(s + q, s + z)}
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *best, sha("".join(f"{s},{z},{q}\n" for s, z, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("portion", [400_000, 300])
def test_query_against_brute_force(spark, tables, monkeypatch, portion):
    monkeypatch.setattr(periodic_runs, "WORDS", portion)
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b\x0b", "ç", "\xa0", "d"]) for _ in range(r.randint(0, 60))) for _ in range(120)]
    texts += [" ".join([" ".join(r.choice("abc") for _ in range(r.randint(1, 9)))] * r.randint(2, 30)) + " end" for _ in range(120)]
    rows = [(i, t, "en", None, 1) for i, t in enumerate(texts)] + [(7, texts[-1], None, "x", 1)] * 2
    folder = tables(documents=spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    out = queries.QUERIES["op11_periodic_runs"](spark, folder)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted((expected(i, t) for i, t, *_ in rows), key=str)


def test_odd_rows_and_empty_table(spark, odd):
    out = {r.doc_id: r for r in periodic_runs.digest(odd).collect()}
    assert out[1].n_runs == out[2].n_runs == out[3].n_runs == 0 and out[1].best is None if "best" in out[1] else out[1].period is None
    assert out[1].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    # 80,000 words in a cycle of four, one run
    assert (out[9].n_runs, out[9].start, out[9].length, out[9].period, out[9].exponent_milli) == (1, 0, 80_000, 4, 20_000_000)
    assert out[9].collapsed_sha256 == hashlib.sha256(b"the quick brown fox").hexdigest()
    assert out[None].n_runs == 0
    found = periodic_runs.with_runs(odd.withColumnRenamed("bits", "Best"))
    assert found.count() == odd.count() and found.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "ids", "runs", "best", "n_words", "collapsed"]
    assert periodic_runs.digest(odd.limit(0)).count() == 0
