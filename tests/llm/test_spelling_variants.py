import random
import re
import zlib
from bisect import bisect_right
from collections import Counter

import pytest

from tenderlake.llm import queries, spelling_variants as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near_by_brute_force(words):
    """Each word's near words, by every deletion and replacement."""
    known, letters, out = set(words), sorted(set("".join(words))), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1 :]) in known:
                out[w].add(shorter)
                out[shorter].add(w)
            out[w] |= {v for a in letters if (v := w[:i] + a + w[i + 1 :]) != w and v in known}
    return out


def test_trie_over_ranges_finds_each_near_pair_once():
    r = random.Random(3)
    for _ in range(150):
        words = sorted({"".join(r.choice("abcde"[: r.choice([2, 3, 5])]) for _ in range(r.randint(1, 7))) for _ in range(r.randint(1, 120))})
        edges = sorted({r.choice(words)[: r.randint(1, 7)] for _ in range(r.randint(0, 5))})
        around = lambda k: (edges[k - 1] if k else None, edges[k] if k < len(edges) else None)
        ranges, sizes = {}, {}
        for w in words:
            ranges.setdefault(bisect_right(edges, w), []).append(w)
        for k, own in ranges.items():
            for (prefix, c), n in S.edge_children(own, *around(k)).items():
                sizes.setdefault(prefix, Counter())[c] += n
        heavy = {p: max((n, c) for c, n in found.items())[1] for p, found in sizes.items() if len(found) > 1}
        found, light, made = [], {}, 0
        for k, own in ranges.items():
            for i, d, h in S.light_edges(own, *around(k), heavy):
                for key in S.errata(own[i], d, h, 0):
                    made += 1
                    if S.ANY in key:
                        light.setdefault(key, []).append(own[i])
                    elif key in set(words):
                        found.append(tuple(sorted((own[i], key))))
        found += [(a, b) for all in light.values() for a in all for b in all if a < b]
        assert sorted(found) == sorted({tuple(sorted((a, b))) for a, all in near_by_brute_force(words).items() for b in all})
        assert made <= 4 * len(words) * (1 + len(words).bit_length())


def expected(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near, form = near_by_brute_force(list(n)), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


@pytest.mark.parametrize("size", [40_000, 20])
def test_query_against_brute_force(spark, tables, monkeypatch, size):
    monkeypatch.setattr(S, "RANGE", size)
    r = random.Random(5)
    stems = ["".join(r.choice("abéL") for _ in range(r.randint(6, 9))) for _ in range(12)]

    def word():
        w = stems[min(int(r.expovariate(0.5)), 11)]
        if r.random() < 0.35:
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abé") + w[i:], w[:i] + r.choice("abé") + w[i + 1 :]])
        return w

    rows = [(i % 150, " ".join(word() for _ in range(40)) + r.choice(["", "\n12x", "-", " ñandú"])) for i in range(200)] + [(None, None), (None, "abcdef " * 9), (3, "")]
    rows += [(None, "ñnnnnnoo " * 130 + "ñnnnnno " * 26 + "ñnnnnn " * 5)]  # a form that has a form
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n long, word string")
    out = queries.QUERIES["op12_spelling_variants"](spark, tables(documents=docs))
    assert out.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    found = sorted((x.word, x.form or "", x.root, x.n, x.n_near, -1 if x.form_n is None else x.form_n) for x in out.collect())
    assert found == expected(rows)
    assert sum(bool(x[1]) for x in found) > 50 and any(x[1] and x[1] != x[2] for x in found)


def test_odd_rows_and_empty_table(spark, odd):
    assert sorted((x.word, x.form, x.root, x.n, x.n_near) for x in S.variants(odd).collect()) == []
    few = S.variants(odd.union(odd.where("doc_id = 8")).union(odd.where("doc_id = 8")).union(odd.where("doc_id = 8")).union(odd.where("doc_id = 8"))).collect()
    assert [(len(x.word), x.n, x.n_near) for x in few] == [(60_000, 5, 0)]  # a very long word
    assert S.variants(odd.limit(0)).count() == 0
