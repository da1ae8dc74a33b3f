"""A cycle makes each contract, document and source row once, and moves them no oftener than by bucket."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import normalize
from tenderlake.plans import ingestion
from tenderlake.sources import cycles, days
from tenderlake.sources.store import Store

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("derive", [cycles.derive_contracts, days.derive])
def test_a_cycle_reads_each_document_once(spark, store, monkeypatch, derive):
    read, whole = spark.sparkContext.accumulator(0), normalize.contracts

    def counted(raw):
        @F.udf("string")
        def seen(x):
            read.add(1)
            return x

        return whole(raw.withColumn("content", seen.asNondeterministic()("content")))

    monkeypatch.setattr(normalize, "contracts", counted)
    for k, state in enumerate(("open", "shut")):
        said = [(f"r{n}", f'{{"id_contrato": "C{n}", "estado_contrato": "{state}", "fecha_de_firma": "2020-03-0{1 + n % 9}", "documento_proveedor": "900{n % 3}"}}', datetime(2020, 4, 1 + k), date(2020, 3, 1 + n % 9)) for n in range(20)]
        rows = spark.createDataFrame(said, "row_id string, content string, seen_at timestamp, fact_on date")
        cycles.run_cycle(store, "c", lambda first, last, rows=rows: rows, date(2020, 3, 31), start=date(2020, 3, 1), derive=derive, buckets=3)
        assert read.value == 20 * (k + 1)
    assert {(x.state, x.n) for x in store.read("contract").groupBy("state").agg(F.count("*").alias("n")).collect()} == {("shut", 20)}


def test_an_insert_and_an_upsert_shuffle_rows_by_bucket_only(spark, store, monkeypatch):
    """Each write's plan has one shuffle, the one by bucket; before, most had two and an insert six."""
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (plans.append(plan(self._df)), write(self, *a, **k))[1])
    rows = lambda *v: spark.createDataFrame(v, "id long, kind string, v string")
    for said in ([(1, "a", "x"), (1, "a", "x"), (None, None, "x")], [(1, "a", "y"), (1, "b", "y"), (1, "b", "y"), (2, None, "y"), (None, None, "y")]):
        tx = store.begin()
        fresh = tx.insert("h", rows(*said), ["id", "kind"], ["id"], buckets=4)
        tx.upsert("t", rows(*said), ["id", "kind"], [F.desc("v")], buckets=4)
        tx.commit()
    assert plans and max(len(re.findall(r"\bExchange\b", p)) for p in plans) == 1
    assert {(x.id, x.kind, x.is_new) for x in fresh.collect()} == {(1, "b", False), (2, None, True)} and fresh.count() == 2
    assert sorted(map(tuple, store.read("h").collect()), key=str) == sorted([(1, "a", "x"), (None, None, "x"), (1, "b", "y"), (2, None, "y")], key=str)
    assert sorted(map(tuple, store.read("t").collect()), key=str) == sorted([(1, "a", "y"), (None, None, "y"), (1, "b", "y"), (2, None, "y")], key=str)


def test_a_document_is_parsed_once_for_all_fields(spark):
    """Of a field said twice the first that is not null counts, as ever."""
    said = ['{"id_contrato": "C1", "id_contrato": "C2", "orden": null, "orden": " nacional "}', '{"id_contrato": 1.50, "ciudad": "\\u00a0Bogot\\u00e1 \\n"}', '{"id_contrato": "C3", ', "[]", None]
    made = normalize.contracts(spark.createDataFrame([(x,) for x in said], "content string"))
    assert sorted((x.contract_id, x.admin_level, x.municipality) for x in made.collect()) == [("1.5", None, " BOGOTA"), ("C1", "NACIONAL", None)]
    shown = plan(made)
    # the fields of a document that says one twice, besides: only where it does
    assert shown.count("json_tuple(") == 1 and shown.count("get_json_object(") <= 15 and shown.count("jsonObjectKeys(") <= 2


def test_the_source_makes_no_document_outside_the_range(spark):
    rows = ingestion.published_contracts(spark, SF, date(1996, 1, 1), date(1996, 1, 31))
    shown = plan(rows)
    assert shown.count("get_json_object(") == 0 and len(re.findall(r"FileScan parquet[^\n]*o_orderkey", shown)) == 1
    days_ = {x.fact_on for x in rows.select("fact_on").collect()}
    assert days_ and min(days_) >= date(1996, 1, 1) and max(days_) <= date(1996, 1, 31)
    assert rows.where(F.to_date(F.get_json_object("content", "$.fecha_de_firma").substr(1, 10)) != F.col("fact_on")).count() == 0
