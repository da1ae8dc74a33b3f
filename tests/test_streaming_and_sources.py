import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenderlake.sources import derived, landing
from tenderlake.streaming import ingest


def test_stream_appends_each_version_once(spark, tmp_path):
    schema = "dataset string, row_id string, content string, seen_at timestamp"
    page = lambda name, rows: spark.createDataFrame([("c", i, c, datetime(2026, 1, 1)) for i, c in rows], schema).coalesce(1).write.json(f"{tmp_path}/{name}")
    page("in/1", [("a", '{"v":"1"}'), ("a", '{"v":"1",":id":"z"}'), ("b", '{"v":"1"}')])
    source = lambda: spark.readStream.schema(schema).json(f"{tmp_path}/in/*")
    run = lambda: ingest.append_stream(source(), f"{tmp_path}/raw", f"{tmp_path}/check").awaitTermination()
    run()
    page("in/2", [("a", '{"v":"2"}'), ("b", '{"v":"1"}'), ("c", '{"v":"1"}')])
    run()
    run()
    got = sorted((r.row_id, r.content[:9], r.is_new) for r in spark.read.parquet(f"{tmp_path}/raw").collect())
    assert got == [("a", '{"v":"1"}', True), ("a", '{"v":"2"}', False), ("b", '{"v":"1"}', True), ("c", '{"v":"1"}', True)]


def test_windows_on_a_stream(spark, tmp_path):
    rows = [(datetime(2026, 1, d, 3), 1, "x", 2.0) for d in (1, 1, 2, 9)]
    spark.createDataFrame(rows, "ts timestamp, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("ts timestamp, user_id long, event_type string, value double").parquet(f"{tmp_path}/e")
    q = ingest.windowed(stream).writeStream.outputMode("append").format("memory").queryName("win").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.start.day, r.n) for r in spark.table("win").collect()) == [(1, 2), (2, 1)]


def test_latest_versions_keep_state(spark, tmp_path):
    rows = [(1, datetime(2026, 1, 1), "a"), (1, datetime(2026, 1, 2), "b"), (1, datetime(2026, 1, 3), "b"), (2, datetime(2026, 1, 1), "a")]
    spark.createDataFrame(rows, "row_id long, ts timestamp, content string").coalesce(1).write.parquet(f"{tmp_path}/v")
    stream = spark.readStream.schema("row_id long, ts timestamp, content string").parquet(f"{tmp_path}/v")
    q = ingest.latest_versions(stream).writeStream.outputMode("update").format("memory").queryName("ver").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.row_id, r.content, r.changes) for r in spark.table("ver").collect()) == [(1, "b", 2), (2, "a", 1)]


def test_sources(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    for i in range(2):
        (tmp_path / f"pages/page-{i}.json").write_text(json.dumps([{"id": f"{i}{k}", "n": "é"} for k in range(3)]), encoding="utf-8")
    spark.dataSource.register(landing.PagedSource)
    got = spark.read.format("paged").load(f"{tmp_path}/pages")
    assert got.count() == 6 and got.where(F.get_json_object("content", "$.id") == "12").first().page == "page-1.json"
    (tmp_path / "rows.json").write_text('{"id_contrato":"C1",":id":"x"}\n\n{"id_contrato":"C2"}\n')
    raw = landing.raw_pages(spark, f"{tmp_path}/rows.json", "contratos", ["id_contrato"])
    assert sorted(r.row_id for r in raw.collect()) == ["C1", "C2"] and raw.first().dataset == "contratos"
    (tmp_path / "ids.txt").write_text("# reviewed\nP1 fine\n\nP2 # too\n")
    assert sorted(r.process_id for r in landing.id_list(spark, f"{tmp_path}/ids.txt").collect()) == ["P1", "P2"]
    (tmp_path / "m.csv").write_text("codigo,nombre\n05001,Medellín\n11001,Bogotá\n")
    assert landing.municipalities(spark, f"{tmp_path}/m.csv", ["05", "11"], 2, 0).count() == 2
    for text, why in (("codigo,nombre\n", "empty"), ("codigo,nombre\n05001,a\n05001,b\n", "doubled"), ("codigo,nombre\n5001,a\n11001,b\n", "malformed"), ("codigo,nombre\n99001,a\n11001,b\n", "unknown")):
        (tmp_path / "m.csv").write_text(text)
        with pytest.raises(ValueError, match=why):
            landing.municipalities(spark, f"{tmp_path}/m.csv", ["05", "11"], 2, 0)
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert landing.as_document(df, "rows").first()[0] == '{"rows":[{"a":1,"b":null}]}' and landing.as_document(df.limit(0), "rows").first()[0] == '{"rows":null}'
    with pytest.raises(ValueError):
        landing.range_filter("d", "2026-02-01", "2026-01-01")


def test_append_stream_within_an_overlap(spark, tmp_path):
    schema = "dataset string, row_id string, content string, seen_at timestamp"
    page = lambda name, rows: spark.createDataFrame([("c", i, c, datetime(2026, m, 1)) for i, c, m in rows], schema).coalesce(1).write.json(f"{tmp_path}/{name}")
    run = lambda: ingest.append_stream(spark.readStream.schema(schema).json(f"{tmp_path}/in/*"), f"{tmp_path}/raw", f"{tmp_path}/check", overlap="45 days").awaitTermination()
    page("in/1", [("a", '{"v":1}', 1), ("b", '{"v":1}', 3)])
    run()
    page("in/2", [("a", '{"v":1}', 4), ("b", '{"v":1}', 4), ("b", '{"v":"1"}', 4)])
    run()
    got = sorted((r.row_id, r.content, r.seen_at.month) for r in spark.read.parquet(f"{tmp_path}/raw").collect())
    # b's first version is within 45 days, a's is not; a number and a text are different contents
    assert got == [("a", '{"v":1}', 1), ("a", '{"v":1}', 4), ("b", '{"v":"1"}', 4), ("b", '{"v":1}', 3)]


def test_derived_tables(spark, tmp_path):
    made = derived.DerivedTable(spark, f"file://{tmp_path}/t", ["k"])
    with pytest.raises(FileNotFoundError):
        made.read()
    rows = lambda *x: spark.createDataFrame(list(x), "k long, v string, at long")
    made.upsert(rows((1, "a", 1), (1, "b", 2), (2, "c", 1)), [F.desc("at")])
    made.upsert(rows((2, None, 3), (3, "d", 3)), [F.desc("at")])
    assert sorted(tuple(r)[:2] for r in made.read().collect()) == [(1, "b"), (2, None), (3, "d")]
    (tmp_path / "t/v9").mkdir()  # a write that was not committed
    assert made.versions() == [0, 1]
    assert made.rewrite(rows((5, "e", 1))).count() == 1 and made.versions()[-1] == 2
    dry = derived.DryRun()
    assert dry.upsert(rows((1, "a", 1)), []) == 0 and dry.seen == 1


def test_retries():
    said, slept = iter([landing.Failed(503), ConnectionError(), landing.Failed(429, 7.0), landing.Failed(408, 900.0), "page"]), []

    def ask():
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x

    assert landing.with_retries(ask, sleep=slept.append, chance=lambda: 0.0) == "page"
    assert slept == [1.0, 2.0, 7.0, 60.0]
    for answer in ([landing.Failed(404)], [landing.Failed(500)] * 5):
        said, slept = iter(answer), []
        with pytest.raises(landing.Failed):
            landing.with_retries(ask, sleep=slept.append)
        assert len(slept) == len(answer) - 1
    assert list(landing.waits(9, chance=lambda: 1.0)) == [2, 4, 8, 16, 32, 60, 60, 60]


def test_two_writers_of_a_derived_table(spark, tmp_path, monkeypatch):
    from tenderlake.sources.derived import DerivedTable
    from tenderlake.sources.store import Conflict

    one, two = (DerivedTable(spark, str(tmp_path / "t"), ["id"]) for _ in range(2))
    one.rewrite(spark.range(3))
    monkeypatch.setattr(two, "versions", lambda: [])  # it has looked before the other wrote
    with pytest.raises(Conflict):
        two.rewrite(spark.range(5))
    assert one.read().count() == 3
    for n in (4, 5, 6):
        one.rewrite(spark.range(n))
    assert one.read().count() == 6 and one.versions() == [2, 3]
    assert not list((tmp_path / "t").glob(".new-*"))


def test_insert_stream_adds_each_version_once(spark, tmp_path):
    from tenderlake.sources.store import Store
    from tenderlake.streaming import ingest

    store = Store(spark, str(tmp_path / "store"))
    schema = "dataset string, row_id string, content string, seen_at timestamp"

    def batch(*rows):
        spark.createDataFrame(rows, "row_id string, content string").selectExpr("'d' AS dataset", "row_id", "content", "current_timestamp() AS seen_at").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.insert_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), store, f"{tmp_path}/check", buckets=2).awaitTermination()
        return sorted((x.row_id, x.content) for x in store.read("raw").collect())

    assert batch(("1", '{"a": 1}'), ("2", '{"a": 1}')) == [("1", '{"a": 1}'), ("2", '{"a": 1}')]
    assert batch(("1", '{ "a":1 }'), ("1", '{"a": 2}')) == [("1", '{"a": 1}'), ("1", '{"a": 2}'), ("2", '{"a": 1}')]
    # the checkpoint's last batch is lost, as if the driver had died after the store's commit: it runs again and adds nothing
    last = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for crc in (tmp_path / "check" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    assert len(batch(("3", '{"a": 1}'))) == 4
