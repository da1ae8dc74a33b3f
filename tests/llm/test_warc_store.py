import gzip
import hashlib
import os

import pytest

from tenderlake.llm import queries, warc_store

SF = "/root/testdata/sf0.01"


def brute(rows):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, p in payload:
        same = [j for j, q in payload if q == p and j is not None]
        refers = max(same) if len(p) >= 1000 and i is not None and i != max(same) else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op7_warc_store(spark, SF).collect()), key=str) == brute(rows)


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "é" * 600
    rows = [(1, "http://a.org/x", big), (2, "http://a.org/x", big), (3, "https://www.B.org:81/y?q=1#f", big + "!"), (4, None, None), (5, "", ""), (6, "http://a.org/s", "same"), (7, "http://a.org/s", "same"),
            (8, "not a url [", "x" * 1000), (None, "http://a.org/n", big), (9, "http://a.org/ sp\nace", "\r\n\r\nHTTP/1.1\r\n" * 100), (2, "http://a.org/x", big), (10, "http://c.org", "z" * 6_000_000)]
    return spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, digest string").repartition(3)


def test_odd_rows(spark, tables, pages):
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted(map(tuple, queries.op7_warc_store(spark, tables(pages=pages)).collect()), key=str) == brute(rows)
    assert queries.op7_warc_store(spark, tables(pages=pages.limit(0))).collect() == []


def test_look_up(spark, pages, monkeypatch, tmp_path):
    monkeypatch.setattr(warc_store, "BLOCK_LINES", 2)
    archive = warc_store.store(pages.select("page_id", "url", "html"), f"file://{tmp_path}/w")
    found = [h["warc-record-id"] for h, _ in archive.look_up("http://a.org/x")]
    assert sorted(found) == ["<urn:page:1>", "<urn:page:2>", "<urn:page:2>"]
    assert [h["warc-target-uri"] for h, _ in archive.look_up("http://www.b.org:81/y?q=1")] == ["https://www.B.org:81/y?q=1#f"]
    assert archive.look_up("http://nowhere.org/") == [] and len(archive.look_up("http://c.org")[0][1]) > 6_000_000
    # archives are series of gzip members that any reader of WARC can read
    whole = b"".join(gzip.open(f"{tmp_path}/w/archive/{f}").read() for f in os.listdir(tmp_path / "w/archive"))
    assert whole.count(b"WARC/1.1\r\n") == pages.count()


@pytest.mark.parametrize("rows", [500_000, 3, 1])
def test_many_blocks_and_levels(spark, pages, monkeypatch, rows):
    """Blocks of two lines, directories of one level and of several, and a key with more captures than a block has."""
    monkeypatch.setattr(warc_store, "BLOCK_LINES", 2)
    monkeypatch.setattr(warc_store, "DIRECTORY_ROWS", rows)
    hot = spark.createDataFrame([(100 + i, "http://hot.org/" if i % 3 else f"http://hot.org/{i}", f"page {i}") for i in range(60)], "page_id long, url string, html string")
    both = pages.select("page_id", "url", "html").union(hot)
    archive = warc_store.store(both)
    assert (len(archive.directories) > 2) == (rows < 500_000) and len(archive.sparse) <= max(rows, 3)
    want = sorted((r.page_id, r.url) for r in both.collect() if r.page_id is not None and r.page_id >= 100)
    assert sorted((r.page_id, r.url) for r in archive.records(hot.select("url").union(hot.select("url"))).collect()) == want
    assert archive.records(both.select("url"), html=False).count() == both.count()
    assert archive.look_up("http://nowhere.org/") == []


def test_roles_are_alike_beyond_the_size_of_a_broadcast(spark, pages, monkeypatch):
    rows = sorted(map(tuple, warc_store.with_roles(pages).collect()), key=str)
    monkeypatch.setattr(warc_store, "REPEATED_ROWS", 0)
    assert sorted(map(tuple, warc_store.with_roles(pages).collect()), key=str) == rows


def test_keys():
    assert warc_store.url_key("http://News.Example.com/a?b=1#c") == "com,example,news)/a?b=1"
    assert warc_store.url_key(None) == ")/"


def test_damage_is_an_error(spark, pages, tmp_path):
    archive = warc_store.store(pages.where("page_id = 3").select("page_id", "url", "html"), f"file://{tmp_path}/w")
    name = os.listdir(tmp_path / "w/archive")[0]
    raw = gzip.open(f"{tmp_path}/w/archive/{name}").read().replace("é".encode() * 3, b"eeeeee", 1)
    packed = gzip.compress(raw)
    (tmp_path / "w/archive" / name).write_bytes(packed + b"\0" * 1000)
    with pytest.raises(Exception, match="damaged|Error"):
        archive.records(pages.select("url")).collect()
