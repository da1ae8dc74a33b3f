"""What only larger tables show: queries on tables made for it, against their oracles where they have one."""

import os
from datetime import date

import duckdb
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tenderlake.plans import catalog, reports  # noqa: F401  reports adds its queries to the catalogue
from tenderlake.sources import pages


def same(spark, folder, name, tables):
    """Whether a query equals its oracle over a folder."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    got = catalog.QUERIES[name](spark, str(folder)).select(*names).collect()
    return sorted(map(tuple, got), key=repr) == sorted(result.fetchall(), key=repr)


@pytest.fixture
def suppliers(tmp_path):
    """Suppliers whose numbers have nine digits, and ten from 1, 2 and 3."""
    duckdb.execute(f"COPY (SELECT k AS s_suppkey FROM (SELECT unnest([range(25200, 25400), range(200000, 200050), range(359000, 359050)]) AS ks), unnest(ks) t(k)) TO '{tmp_path}/supplier.parquet'")
    return tmp_path


def test_check_digits_of_numbers_of_ten_digits(spark, suppliers):
    assert same(spark, suppliers, "check_digits", ["supplier"])


def test_supplier_numbers_of_ten_digits_are_whole_and_lose_their_check_digit(spark, suppliers):
    assert same(spark, suppliers, "supplier_numbers", ["supplier"])


def test_many_pages_share_tasks_of_bounded_rows(spark, tmp_path):
    made = [{"page": f"p{i:06}", "first": "2020-01-01", "last": "2020-01-02", "rows": 200, "landed": 1} for i in range(100_000)]
    for edges in ((None, None), ("2020-01-02", None)):
        tasks = pages._within(made, *edges)
        assert [n for t in tasks for n in t.names] == [x["page"] for x in made]
        assert len(tasks) <= 400 and max(len(t.names) for t in tasks) * 200 <= pages.ROWS
    assert len(pages._within(made[:5], None, None)) == 5
    pages.register(spark)
    folder = f"file://{tmp_path}/landed"
    rows = spark.range(1000).select(F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 100).cast("int")).alias("day"), F.col("id").cast("string").alias("content"))
    pages.land(rows, folder, 5)
    every = spark.read.format("dated_pages").load(folder)
    assert every.rdd.getNumPartitions() <= pages.TASKS < len(pages.index(folder))
    assert sorted(int(x.content) for x in every.collect()) == list(range(1000))


def test_processes_and_errata_come_from_one_shuffle_before_any_sort(spark):
    """No task sorts its split of the lines: what it sorts is a partition of the shuffle."""
    from tenderlake.operators import quality
    from tenderlake.plans import bindings as b

    sf = "/root/testdata/sf0.001"
    lines = b._lines(spark, sf)
    plan = quality.ends(lines, b.newest())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(process_id") == 1
    assert "Sort" not in plan[plan.index("hashpartitioning(process_id") :].replace("SortMergeJoin", "")
    # the same rows as one pass for each has them
    snapshots = b.snapshots(spark, sf)
    for made, want in ((b.processes(spark, sf), b.raw.latest(snapshots, ["process_id"], b.newest())), (b.errata(spark, sf), quality.errata(snapshots, b.newest()))):
        assert made.columns == want.columns
        assert made.count() == want.count() > 0 and made.exceptAll(want).isEmpty()
    assert "lineitem" not in b.errata(spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_a_stores_buckets_grow_with_the_orders_and_a_task_has_one(spark, tmp_path, monkeypatch):
    from tenderlake.plans import ingestion
    from tenderlake.sources.store import Store

    sf = "/root/testdata/sf0.001"
    assert ingestion.buckets(spark, sf) == ingestion.BUCKETS
    monkeypatch.setattr(ingestion, "BUCKET_BYTES", 2000)
    n = ingestion.buckets(spark, sf)
    assert n == -(-os.path.getsize(f"{sf}/orders.parquet") // 2000) > ingestion.BUCKETS
    # by a hash of the bucket's number several buckets met in one task
    store = Store(spark, str(tmp_path / "store"))
    tx = store.begin()
    written = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda self, path, write=DataFrameWriter.parquet: (written.append(self._df), write(self, path))[1])
    tx.insert("t", spark.range(5000).select("id"), ["id"], ["id"], n)
    for df in written:
        shares = df.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("__bucket").alias("n")).collect()
        assert len(shares) == n and {x.n for x in shares} == {1}
    tx.commit()
    assert store.read("t").count() == 5000


@pytest.mark.parametrize("hot", [1, 12, 1000])
def test_overlaps_deal_only_busy_keys_to_months(spark, hot):
    import random
    from datetime import timedelta

    from tenderlake.operators import windows

    r = random.Random(5)
    made = [(i, k, date(2000, 1, 1) + timedelta(r.randrange(2000)), r.choice([0, 3, 40, 900]), r.choice([1, 2, None])) for k, n in ((1, 40), (2, 10), (3, 12), (None, 5)) for i in range(1000 * (k or 9), 1000 * (k or 9) + n)]
    made = [(i, k, s, s + timedelta(d), o) for i, k, s, d, o in made]
    rows = spark.createDataFrame(made, "id int, k int, s date, e date, o int").repartition(3)
    out = windows.overlaps(rows, "k", "id", "s", "e", "o", hot=hot)
    want = [(x[1], x[0], y[0], (min(x[3], y[3]) - max(x[2], y[2])).days + 1) for x in made for y in made if x[1] == y[1] is not None and x[0] < y[0] and x[2] <= y[3] and y[2] <= x[3] and x[4] != y[4]]
    assert sorted((x.k, x.a_id, x.b_id, x.days) for x in out.collect()) == sorted(want)


def test_intervals_of_keys_of_few_are_a_row_each(spark):
    """Each lasts fifty years; by months they were 601 rows."""
    from tenderlake.operators import windows

    rows = spark.range(2000).select("id", (F.col("id") % 500).alias("k"), F.lit(date(1970, 1, 1)).alias("s"), F.lit(date(2020, 1, 1)).alias("e"), (F.col("id") % 3).alias("o"))
    assert windows.dealt(rows, "k", "id", "s", "e", "o").count() == 2000
    assert windows.dealt(rows, "k", "id", "s", "e", "o", hot=1).count() == 2000 * 601


def test_a_documents_fields_are_read_once(spark):
    """Its supplier's number was read from the text at each of its mentions, over a hundred."""
    plan = catalog.QUERIES["normalized_contracts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") <= 40


BASE = ["lineitem", "part", "orders", "customer", "nation", "supplier"]
#: Rows of a table that are there twice.
TWICE = {"orders": "o_custkey < 20 AND o_orderkey % 3 = 0", "customer": "c_custkey % 11 = 5", "supplier": "s_suppkey % 2 = 1"}


@pytest.fixture(params=["none", *TWICE])
def twice(request, tmp_path):
    """Base tables without some customers, and with rows of the named table given twice."""
    sf = "/root/testdata/sf0.001"
    for t in BASE:
        again = f"UNION ALL SELECT * FROM '{sf}/{t}.parquet' WHERE {TWICE[t]}" if t == request.param else ""
        duckdb.execute(f"COPY (SELECT * FROM '{sf}/{t}.parquet' {'WHERE c_custkey % 7 <> 3' if t == 'customer' else ''} {again}) TO '{tmp_path}/{t}.parquet'")
    return request.param, tmp_path


def test_what_orders_and_customers_say_reads_no_line(spark, twice, monkeypatch):
    from tenderlake.plans import bindings as b

    table, sf = twice[0], str(twice[1])
    written, rewrite = [], b.DerivedTable.rewrite
    monkeypatch.setattr(b.DerivedTable, "rewrite", lambda self, rows: (written.append(self.path.split("/")[-1]), rewrite(self, rows))[1])
    for name in ("mean_note", "median_and_mean", "top1pct_share", "contract_states", "impossible_values", "last_day_with_contracts", "base_period"):
        assert same(spark, sf, name, BASE)
    # only where a supplier is given twice do the lines say how often a contract is there
    assert written == (["ends", "contracts"] if table == "supplier" else [])
    before, every = b.signed(spark, sf), b.contracts(spark, sf).select(*b.OWN)
    after = b.signed(spark, sf)
    assert before.schema == after.schema == every.schema and every.count() > 0
    assert before.exceptAll(every).isEmpty() and every.exceptAll(before).isEmpty()
    assert same(spark, sf, "mean_note", BASE)


def test_links_of_groups_of_rows_given_twice(spark, twice):
    """Without contracts and with them."""
    from tenderlake.plans import bindings as b

    table, sf = twice[0], str(twice[1])
    assert same(spark, sf, "links_of_groups", BASE)
    assert (b.contracts.made(spark, sf) is None) == (table != "supplier")
    b.contracts(spark, sf)
    assert same(spark, sf, "links_of_groups", BASE)


def test_contracts_go_to_their_processes_by_the_orders_key(spark, tmp_path, monkeypatch):
    """Those without a link had a null key, all of them in one task."""
    from tenderlake.plans import bindings as b

    (tmp_path / "sf").symlink_to("/root/testdata/sf0.001")
    made, rewrite = {}, b.DerivedTable.rewrite
    monkeypatch.setattr(b.DerivedTable, "rewrite", lambda self, rows: (made.update({self.path.split("/")[-1]: rows._jdf.queryExecution().executedPlan().toString()}), rewrite(self, rows))[1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b.contracts(spark, str(tmp_path / "sf"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(o_orderkey" in made["contracts"] and "hashpartitioning(link_key" not in made["contracts"]
