import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tenderlake.llm import components, queries, simhash_dedup

SF = "/root/testdata/sf0.01"


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, f"{p:016x}", least.get(top(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


@pytest.mark.parametrize("odd_rows", [False, True])
def test_matches_brute_force(spark, odd, tables, odd_rows):
    folder = tables(documents=odd) if odd_rows else SF
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op4_simhash_dedup(spark, folder).collect()), key=str) == brute(rows)


def test_empty_table(spark, odd, tables):
    assert queries.op4_simhash_dedup(spark, tables(documents=odd.limit(0))).collect() == []


@pytest.mark.parametrize(("tile", "blocks"), [(4096, 4), (8, 4), (4096, 6), (8, 5)])
def test_links_join_the_same_components_as_brute_force(spark, tile, blocks):
    """Clusters within few bits, many with equal blocks, through one tile a key and through many."""
    rng = random.Random(6)
    base = [rng.getrandbits(64) & 0xFFFFFFFF0000FFFF for _ in range(12)]
    bits = {rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(500)}
    signed = sorted(b - (1 << 64) if b >> 63 else b for b in bits)
    df = spark.createDataFrame([(b,) for b in signed], "bits long")
    got = simhash_dedup.links(df, tile=tile, blocks=blocks).collect()
    x = np.array(signed, np.int64).view(np.uint64)
    assert all((np.int64(r.u).view(np.uint64) ^ np.int64(r.v).view(np.uint64)).bit_count() <= 64 for r in got)

    def parts(pairs):
        root = np.arange(len(x))
        place = {b: i for i, b in enumerate(signed)}
        for u, v in pairs:
            simhash_dedup.unite(root, np.array([place[u]]), np.array([place[v]]))
        return root.tolist()

    near = [(signed[i], signed[j]) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3) if i < j]
    assert parts((r.u, r.v) for r in got) == parts(near)


def test_units_skip_pairs_beyond_the_radius_in_population_count(monkeypatch):
    bits = sorted(((1 << n) - 1) << s for n in range(1, 40) for s in range(4))
    bits.sort(key=int.bit_count)
    x = np.array(bits, np.uint64)
    compared, near = [], simhash_dedup._near
    monkeypatch.setattr(simhash_dedup, "_near", lambda a, b, radius: (compared.append(len(a)), near(a, b, radius))[1])
    zero = pa.array([0] * len(x), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array([7] * len(x), pa.int64()), zero, zero, zero, pa.array(x.view(np.int64))], names=["key", "a", "b", "tile", "bits"])
    (found,) = simhash_dedup._compare_units(3)(iter([batch.slice(0, 50), batch.slice(50)]))
    within = sum(b.bit_count() - a.bit_count() <= 3 for i, a in enumerate(bits) for b in bits[i + 1 :])
    assert sum(compared) == within < len(bits) * (len(bits) - 1) // 2
    root, want = np.arange(len(x)), np.arange(len(x))
    place = {b: i for i, b in enumerate(bits)}
    for u, v in zip(*(found.column(c).to_pylist() for c in "uv")):
        simhash_dedup.unite(root, np.array([place[u]]), np.array([place[v]]))
    for i in range(len(x)):
        hit = np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3)
        simhash_dedup.unite(want, np.full(len(hit), i), hit)
    assert root.tolist() == want.tolist()


def test_tiles_are_bounded_and_pairs_beyond_the_radius_are_skipped(spark):
    """One key with 3000 fingerprints: units hold two tiles at most, and tiles far apart in population count do not meet."""
    rng = random.Random(4)
    bits = {sum(1 << b for b in rng.sample(range(63), rng.randint(2, 60))) for _ in range(3000)}
    keyed = spark.createDataFrame([(1, b) for b in bits] + [(2, b) for b in sorted(bits)[:40]], "key long, bits long")
    rows = simhash_dedup.tiled(keyed, 3, 100).collect()
    units, tiles = {}, {}
    for r in rows:
        units.setdefault((r.key, r.a, r.b), []).append(r)
        tiles.setdefault((r.key, r.tile), set()).add(r.bits)
    assert {k for k in units if k[0] == 2} == {(2, 0, 0)} and len(units[2, 0, 0]) == 40
    assert sum(len(t) for (k, _), t in tiles.items() if k == 1) == len(bits) and max(map(len, tiles.values())) < 200
    spread = {k: (min(map(int.bit_count, t)), max(map(int.bit_count, t))) for k, t in tiles.items()}
    n = len([k for k in tiles if k[0] == 1])
    assert len(units) - 1 < n * (n + 1) // 2 / 2
    for (k, a), (low, high) in spread.items():
        for (m, b), (least, most) in spread.items():
            if k == m and a < b and least - high <= 3:  # these must meet, each with all its rows
                assert {r.bits for r in units[k, a, b]} == tiles[k, a] | tiles[k, b]


def test_more_fingerprints_make_more_blocks():
    assert [simhash_dedup.blocks_for(n) for n in (0, 10**6, 10**9, 10**12)] == [4, 4, 5, 6]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 7), (1, 1), (-3, -9)]
    random.Random(1).shuffle(edges)
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {i: 5 for i in (7, *range(200, 260))} | {-3: -9}


def test_one_of_each(spark, odd):
    stay = simhash_dedup.one_of_each(odd)
    assert stay.columns == odd.columns
    # null, empty and word-free texts are alike; rows without an id go
    assert sorted(r.doc_id for r in stay.select(F.col("doc_id")).collect()) == [1, 4, 5, 6, 8, 9, 10, 11]
