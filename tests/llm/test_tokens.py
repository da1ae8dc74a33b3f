import hashlib
import random

import duckdb
import pytest
from tokenizers import Tokenizer

from tenderlake.llm import bpe_codec, queries, token_counts

SF = "/root/testdata/sf0.01"


def library(name):
    made = Tokenizer.from_file(queries.vocabulary(name))
    made.no_truncation()
    made.no_padding()
    return made


def texts_of(folder):
    return duckdb.execute(f"select doc_id, coalesce(text, '') from read_parquet('{folder}/documents.parquet/**', union_by_name=true)" if "sf0" not in folder else f"select doc_id, coalesce(text, '') from '{folder}/documents.parquet'").fetchall()


@pytest.mark.parametrize("odd_rows", [False, True])
def test_counts_match_the_library(spark, odd, tables, odd_rows):
    folder = tables(documents=odd) if odd_rows else SF
    made = library("byte_bpe_50k.json")
    want = sorted(((i, len(t.encode()), n := len(made.encode(t, add_special_tokens=False).ids), n > 512) for i, t in ((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())), key=str)
    got = sorted((tuple(r) for r in queries.op8_token_counts(spark, folder).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)
    assert got == want


@pytest.mark.parametrize("odd_rows", [False, True])
def test_codec_matches_the_library(spark, odd, tables, odd_rows):
    folder = tables(documents=odd) if odd_rows else SF
    made = library("word_bpe_49k.json")
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = made.encode(r.text or "", add_special_tokens=False).ids
        said, back = " ".join(map(str, ids)), made.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in queries.op6_bpe_codec(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_blocks_and_other_columns(spark, odd):
    path = queries.vocabulary("word_bpe_49k.json")
    made = library("word_bpe_49k.json")
    rows = bpe_codec.encode(odd, path, block_chars=20).collect()
    assert len(rows) == odd.count() and rows[0].lang == "en" and rows[0].spans == "own"
    want = {r.doc_id: made.encode(r.text or "", add_special_tokens=False).ids for r in odd.collect()}
    assert all(r.ids == want[r.doc_id] for r in rows)


def test_empty_tables(spark, odd, tables):
    folder = tables(documents=odd.limit(0))
    assert queries.op8_token_counts(spark, folder).collect() == queries.op6_bpe_codec(spark, folder).collect() == []


def test_white_space_and_controls_match_the_library():
    made, count = library("byte_bpe_50k.json"), token_counts.Counter(queries.vocabulary("byte_bpe_50k.json")).counter()
    for c in map(chr, [*range(0x250), 0x1680, *range(0x2000, 0x2030), 0x205F, 0x3000, 0xFEFF]):
        for text in (c, f"a{c}b", f" {c} ", f"a {c}{c} b{c}", f"{c}\n{c}x"):
            assert count(text) == len(made.encode(text, add_special_tokens=False).ids), repr(text)


def test_words_meet_at_any_white_space():
    """Encoding the words between ASCII white space is encoding the text."""
    made = library("word_bpe_49k.json")
    for c in map(chr, [*range(1, 0x250), 0x300, 0x301, 0x345, 0x1680, *range(0x2000, 0x2030), 0x3000]):
        for text in (f"a {c}b", f"E{c} \t{c}a", f"{c}\n{c} {c}"):
            parts = [i for w in text.encode().split() for i in made.encode(w.decode(), add_special_tokens=False).ids]
            assert parts == made.encode(text, add_special_tokens=False).ids, repr(text)


def test_both_ways_of_merging_agree():
    rng = random.Random(8)
    made = token_counts.Counter(queries.vocabulary("byte_bpe_50k.json"))
    for _ in range(2000):
        piece = "".join(rng.choice("etaoinshrdlu\u0120ing") for _ in range(rng.randint(0, 70)))
        assert token_counts._merged_short(piece, made.ranks) == token_counts._merged_long(piece, made.ranks)


def test_decoding_nulls_and_nothing(spark):
    path = queries.vocabulary("word_bpe_49k.json")
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, 49407, 0])], "doc_id long, ids array<int>").coalesce(1)
    piece = bpe_codec.pieces(path)
    assert {r.doc_id: r.decoded for r in bpe_codec.decode(df, path).collect()} == {1: None, 2: "", 3: f"{piece[320]} <|endoftext|> !"}


def test_a_table_that_is_full_begins_anew(spark, monkeypatch):
    path = queries.vocabulary("word_bpe_49k.json")
    monkeypatch.setattr(bpe_codec, "WORDS", 7)
    docs = spark.createDataFrame([(i, " ".join(f"word{(i * k) % 37}" for k in range(40)), "own") for i in range(60)], "doc_id long, text string, __block string").repartition(3)
    made = library("word_bpe_49k.json")
    rows = bpe_codec.encode(docs, path, keep=["__block", "text"], block_chars=500, decoded="text_").collect()
    assert len(rows) == 60 and {r["__block"] for r in rows} == {"own"}
    for r in rows:
        assert r.ids == made.encode(r.text, add_special_tokens=False).ids and r.text_ == made.decode(r.ids, skip_special_tokens=False)


def test_repetitive_texts_are_assembled_within_bounds(spark, monkeypatch):
    """Texts that pack to almost nothing are put together and decoded by their number of ids, not by what they pack to."""
    path, made = queries.vocabulary("word_bpe_49k.json"), library("word_bpe_49k.json")
    monkeypatch.setattr(bpe_codec, "IDS_AT_ONCE", 5000)
    docs = spark.createDataFrame([(i, "the cat " * n) for i, n in enumerate([2000, 2000, 2000, 20_000, 1, 0, 2600, 2])], "doc_id long, text string").coalesce(1)
    encoded = bpe_codec.encode(docs, path, keep=["doc_id", "text"], decoded="said")
    for r in encoded.collect():
        want = made.encode(r.text, add_special_tokens=False).ids
        assert r.ids == want and r.said == made.decode(want, skip_special_tokens=False)
    assert [r.out for r in bpe_codec.decode(encoded.drop("said"), path, out="out").orderBy("doc_id").collect()] == [r.said for r in encoded.orderBy("doc_id").collect()]
    import pyarrow as pa

    assert list(bpe_codec._even(pa.array([[1] * 3000, [1] * 2000, [1], [1] * 9000, None, [1]]))) == [2, 3, 4, 6]


def test_other_vocabularies_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="white space"):
        bpe_codec.encode(docs, queries.vocabulary("byte_bpe_50k.json"))


def test_memory_of_very_repetitive_texts(tmp_path):
    """40 texts of a million equal words: the assembler holds one text's ids and pieces at a time, well below what all of them take (8 bytes a word and more)."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("ids", pa.list_(pa.int32()))])
    packed = bpe_codec._pack(np.zeros(1_000_000, np.uint32))

    class One:
        def __init__(self, *_):
            self.flat, self.start, self.count = np.array([5], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

        of = bpe_codec._Ids.of

    keep, bpe_codec._Ids = bpe_codec._Ids, One
    try:
        batch = pa.RecordBatch.from_pydict({"__block": pa.array([0] * 40, pa.int64()), "__places": pa.array([packed] * 40, pa.binary())})
        tracemalloc.start()
        n = sum(len(out.column(0).values) for out in bpe_codec._assembler(0, schema, "", 1, None)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        bpe_codec._Ids = keep
    assert n == 40_000_000 and peak < 120_000_000
