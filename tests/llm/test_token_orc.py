import random
import struct
import zlib

import pytest

from tenderlake.llm import queries, token_orc


@pytest.fixture(scope="module")
def path():
    return queries.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_encoder_is_the_library(path, library, limit):
    r = random.Random(5)
    signs = ["a", "b", "the", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\0", "\1", "\x0b", "\x1c", "\x85", "\xa0", "　", "é", "1", "22", "½", "$", "--", "\U0001f600", "<|endoftext|>", "<|end", "̀", "漢", "﻿", "​"]
    encoder = token_orc.Encoder(open(path, encoding="utf-8").read(), limit)
    for _ in range(60):
        texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 12))) for _ in range(50)]
        ids, edges = encoder(texts)
        assert [list(ids[a:b]) for a, b in zip(edges, edges[1:])] == [library(t) for t in texts]
        assert len(encoder.places) <= limit


def expected(rows, library):
    at = 0
    for doc_id, text in rows:
        ids = library(text) + [2]
        yield doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)


def test_query_against_the_library(spark, tables, prose, library):
    r = random.Random(7)
    rows = [(i, " ".join(r.sample(prose.split(), r.randint(0, 60))), "own", 5) for i in r.sample(range(1000), 300)]
    folder = tables(documents=spark.createDataFrame(rows, "doc_id long, text string, ids string, file int").repartition(5))
    out = queries.QUERIES["op13_token_orc"](spark, folder)
    assert out.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, out.collect())) == list(expected(sorted(x[:2] for x in rows), library))


def test_odd_rows(spark, odd, path, library):
    out = [tuple(x) for x in token_orc.write(odd, path, 2).digest().orderBy("start").collect()]
    assert [x[0] for x in out] == [None, 1, 2, 3, 4, 5, 6, 6, 8, 9, 10, 11]  # documents without id first, equal rows each
    texts = {x.doc_id: x.text for x in odd.collect()}
    assert out == list(expected([(x[0], texts[x[0]]) for x in out], library))
    assert token_orc.write(odd.limit(0), path, 2).digest().count() == 0


def test_a_hot_id_is_split_and_order_holds(spark, path, library):
    rows = [(5, f"text {i % 50}") for i in range(600)] + [(i, f"word {i}") for i in range(100)]
    files = token_orc.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), path, 2)
    found = files.documents().orderBy("start").collect()
    assert [x.doc_id for x in found] == sorted(i for i, _ in rows)
    assert [x.start for x in found] == [sum(y.n_tokens for y in found[:k]) for k in range(len(found))]
    part = files.slice(100, 110).orderBy("start").collect()
    assert part == [x for x in found if x.start < 110 and x.start + x.n_tokens > 100]


def test_lookups_by_id_are_pushed_to_the_files(spark, path, tmp_path):
    rows = [(2 * i, f"document {i}") for i in range(5000)]
    files = token_orc.write(spark.createDataFrame(rows, "doc_id long, text string"), path, 2, folder=f"{tmp_path}/ids")
    again = token_orc.TokenFiles(spark, f"{tmp_path}/ids")
    found = again.documents([4000, 4001])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan.replace("IsNotNull(doc_id), ", "") or "In(doc_id, [4000,4001])" in plan
    assert [(x.doc_id, x.n_tokens) for x in found.collect()] == [(4000, files.documents([4000]).first().n_tokens)]
    # the files have a Bloom filter and a row index on doc_id, and ids by run lengths
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    name = next(f for f in tmp_path.glob("ids/*.orc"))
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(name)), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0)) if hasattr(reader.rows(), "readStripeFooter") else None
    if footer is not None:
        kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
        assert "ROW_INDEX" in kinds and kinds & {"BLOOM_FILTER", "BLOOM_FILTER_UTF8"}
        assert "DIRECT_V2" in {footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())}
