"""Near-duplicates by 64-bit SimHash and exact tiled comparison.

Fingerprints within 3 bits link. They are cut into blocks of bits; those that
agree in enough blocks share a key, and within the radius they must share one,
so comparing within keys loses no link. How many blocks there are follows from
the number of distinct fingerprints, so that keys stay selective.

The fingerprints of a key are put in the order of their population counts and
cut into tiles of TILE or so. Pairs of tiles whose population counts differ
beyond the radius are skipped; the others, and each tile with itself, are units
of work of bounded size that Spark deals out. In a unit, numpy compares by
exclusive-or and bit counts, passing over rows whose counts differ too much. A
unit returns a spanning forest of its links, never all pairs. Every key goes
this way, whatever its size.

Equal fingerprints meet once only: what follows the fingerprints runs on
distinct ones. Null and empty texts, and those without words, have fingerprint
zero and link like any other; rows that are alike are linked; an empty table
gives an empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, placed, with_columns, written
from .components import components

RADIUS = 3
SHINGLE = 3
TILE = 1024
#: Distinct fingerprints up to which keys of one block of four are selective (2 ** 11 a key on average), and two of five.
FOUR, FIVE = 1 << 27, 1 << 36


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """The SimHash of the text's word shingles as a signed 64-bit number; 0 for texts without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = words[at : min(n, at + (1 << 16)) + shingle - 1]
        joined = [b" ".join(part)] if len(words) < shingle else map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        h = np.array([digest(s, seed) for s in joined], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with bits, the fingerprint as a signed number; a column of that name is replaced."""

    def row() -> Callable[[str | None], tuple]:
        return lambda x: (fingerprint_of(x),)

    return with_columns(docs, text, "bits long", row, keep)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite a[i] with b[i] for all i in the forest root, whose trees stay flat and rooted at their smallest member."""
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= radius


def _forest(bits: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    linked = np.flatnonzero(root != np.arange(len(root)))
    u, v = bits[linked].view(np.int64), bits[root[linked]].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _compare_units(radius: int):
    """Links within the units of a partition, which is sorted by unit and population count.

    Rows are key, a, b (the unit: two tiles of a key, or one twice), tile and bits.
    """

    def compare(unit: np.ndarray, cross: np.ndarray, tile: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        root, ones = np.arange(len(unit)), np.bitwise_count(bits).astype(np.int16)
        at, k = root[:-1], 1
        while True:
            at = at[at + k < len(unit)]
            # counts ascend within a unit: a row beyond the radius has none nearer after it
            at = at[(unit[at] == unit[at + k]) & (ones[at + k] - ones[at] <= radius)]
            if not len(at):
                return _forest(bits, root)
            # what stands in one tile has met in that tile's own unit
            pair = at[~cross[at] | (tile[at] != tile[at + k])]
            hit = pair[_near(bits[pair], bits[pair + k], radius)]
            if len(hit):
                unite(root, hit, hit + k)
            k += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = tuple(np.zeros(0, np.int64) for _ in range(5))
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "a", "b", "tile", "bits")]
            rows = tuple(np.concatenate(x) for x in zip(rest, new))
            key, a, b, tile, bits = rows
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            unit = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
            cut = starts[-1]  # the last unit may go on in the next batch
            if cut:
                yield compare(unit[:cut], (a != b)[:cut], tile[:cut], bits[:cut].view(np.uint64))
            rest = tuple(x[cut:] for x in rows)
        if len(rest[0]):
            yield compare(np.zeros(len(rest[0]), np.int64), rest[1] != rest[2], rest[3], rest[4].view(np.uint64))

    return run


def block_keys(bits: Column, radius: int, blocks: int) -> Column:
    """A number for each choice of blocks - radius blocks, from the choice and the blocks' values."""
    size = -(-64 // blocks)
    mask = lambda chosen: sum(((1 << min(size, 64 - b * size)) - 1) << (b * size) for b in chosen)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    choices = list(combinations(range(blocks), blocks - radius))
    if blocks == radius + 1 and size == 16:  # small numbers without collisions
        return F.array(*(F.lit(b << 16).cast("long") + F.shiftrightunsigned(bits, 16 * b).bitwiseAND(65535) for b in range(blocks)))
    return F.array(*(F.xxhash64(F.lit(i), bits.bitwiseAND(F.lit(signed(mask(c))))) for i, c in enumerate(choices)))


def blocks_for(distinct: int) -> int:
    """How many blocks keep the keys of so many fingerprints selective."""
    return 4 if distinct <= FOUR else 5 if distinct <= FIVE else 6


def tiled(keyed: DataFrame, radius: int, tile: int) -> DataFrame:
    """Units of work: key, a and b (two tiles, or one twice), tile and bits, from rows of key and bits.

    Where a row stands in its key's order follows from the key's counts by
    population count (65 at most), with the rows of one count in the order of a
    hash. So no key is sorted, or counted by one task.
    """
    ones = F.bit_count("bits").cast("int")
    counts = keyed.groupBy("key", ones.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    many = counts.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "n")))).alias("ns"), F.sum("n").alias("rows")).where(F.col("rows") > tile)
    below = lambda ns, p: F.aggregate(F.map_entries(ns), F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["key"] < p, e["value"]).otherwise(0))
    # the tiles of a key: from the first place of each count to its last, in steps of a tile
    spans = F.transform(F.map_entries("ns"), lambda e: F.struct(e["key"].alias("p"), e["value"].alias("n"), below(F.col("ns"), e["key"]).alias("at")))
    many = written(many.select(F.col("key").alias("k"), spans.alias("spans")), "tiled-keys")
    placed = keyed.join(many, F.col("key") == F.col("k"), "left").withColumn("p", ones)
    own = F.element_at(F.filter("spans", lambda s: s["p"] == F.col("p")), 1)
    number = lambda place: F.floor(place / tile).cast("long")
    placed = placed.withColumn("own", own).withColumn("tile", F.coalesce(number(F.col("own.at") + F.pmod(F.xxhash64("bits"), F.col("own.n"))), F.lit(0).cast("long")))
    # tiles that hold a count within the radius of a row's own tile's; the others are skipped
    mine = F.filter("spans", lambda s: (number(s["at"]) <= F.col("tile")) & (number(s["at"] + s["n"] - 1) >= F.col("tile")))
    reach = F.transform(F.array(F.struct(F.array_min(F.transform(mine, lambda s: s["p"])).alias("low"), F.array_max(F.transform(mine, lambda s: s["p"])).alias("high"))), lambda r: F.filter("spans", lambda s: s["p"].between(r["low"] - radius, r["high"] + radius)))[0]
    others = F.sequence(number(F.array_min(F.transform(reach, lambda s: s["at"]))), number(F.array_max(F.transform(reach, lambda s: s["at"] + s["n"] - 1))))
    dealt = placed.select("key", "bits", "tile", F.explode(F.coalesce(others, F.array(F.lit(0).cast("long")))).alias("with"))
    return dealt.select("key", F.least("tile", "with").alias("a"), F.greatest("tile", "with").alias("b"), "tile", "bits")


def links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int | None = None, tile: int | None = None) -> DataFrame:
    """Links u, v among the distinct values of fingerprints' column bits: a spanning forest of each unit of work.

    blocks is how many blocks the 64 bits are cut into, by default what suits
    the number of fingerprints.
    """
    if blocks is None:
        blocks = max(radius + 1, blocks_for(fingerprints.count()))
    keyed = fingerprints.select(F.explode(block_keys(F.col("bits"), radius, blocks)).alias("key"), "bits")
    units = tiled(keyed, radius, tile or TILE).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", F.bit_count("bits"))
    return units.mapInArrow(_compare_units(radius), "u long, v long")


def _rooted(prints: DataFrame, first: Column, radius: int, blocks: int | None) -> DataFrame:
    """The distinct bits of prints, first (an aggregate of their rows) and root, alike for all bits of one group."""
    distinct = written(prints.groupBy("bits").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(links(distinct.select("bits"), radius, blocks))
    return distinct.join(roots.withColumnRenamed("u", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id of the texts it reaches.

    Null and empty texts have fingerprint zero and link like any other. A null
    doc_id never names a component that has others.
    """
    prints = written(with_fingerprints(docs.select(doc_id, text), text, [doc_id]), "fingerprints")
    rooted = _rooted(prints, F.min(doc_id), radius, blocks)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("bits", "component_id")
    return prints.join(named, "bits").select(doc_id, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def _row_key(docs: DataFrame, first: list[str]) -> list[Column]:
    """A row's 128 bits, from the columns in first and then all others: alike for rows that are alike. Maps have no hash and do not count."""
    columns = [F.col(c) for c in (*first, *(c for c, t in docs.dtypes if c not in first and "map<" not in t))]
    return [F.xxhash64(F.lit(i), *columns).alias(f"__key{i}") for i in range(2)]


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", without_id: bool = False) -> DataFrame:
    """One row of docs for each group: that of the smallest doc_id, and of several with that doc_id the smallest by a hash of the row.

    Groups that have no doc_id at all go, or with without_id also keep one row.
    Groups are told apart by their texts alone: a doc_id that several groups
    have as their smallest stays in each. Of rows that are wholly alike one
    stays. docs' columns stay as they are, whatever their names.
    """
    from pyspark.sql import Window

    moved, back = aside(docs)
    words, ident, key = placed(docs, text), placed(docs, doc_id), ["__key0", "__key1"]
    rows = moved.select("*", *_row_key(moved, [words, ident]))
    prints = written(with_fingerprints(rows.select(F.col(ident).alias("id"), F.col(words).alias("words"), *key), "words", ["id", *key]), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), *key)
    chosen = _rooted(prints, F.min(order), RADIUS, None).groupBy("root").agg(F.min("first").alias("first"))
    if not without_id:
        chosen = chosen.where("NOT first.none")
    stay = written(chosen.select("first.__key0", "first.__key1"), "kept-rows")
    # the keys are the side that is hashed: the texts stream past them and are never sorted
    among = lambda keys: rows.join(keys.select(*key).hint("shuffle_hash"), key, "left_semi")
    repeated = written(prints.join(stay, key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "repeated-rows")
    if repeated.isEmpty():
        return among(stay).select(*back)
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    one = among(repeated).withColumn("__n", number).where("__n = 1").drop("__n")
    return among(stay.join(repeated, key, "left_anti")).unionByName(one).select(*back)
