"""The store: untouched buckets stay, commits are atomic, writers conflict, leftovers go."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tenderlake.sources import cycles
from tenderlake.sources.store import Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows(spark, *values):
    return spark.createDataFrame(values, "id long, kind string, v long")


def upsert(store, *values, **options):
    with_order = [F.desc("v")]
    return store.retried(lambda tx: tx.upsert("t", rows(store.spark, *values), ["id", "kind"], with_order, buckets=8))


def contents(store, table="t", version=None):
    return sorted(map(tuple, store.read(table, version).collect()), key=str)


def test_upsert_replaces_by_key_and_leaves_other_buckets(spark, store):
    upsert(store, *[(i, "a", i) for i in range(100)], (None, None, 1))
    before = store.record()["tables"]["t"]["folders"]
    upsert(store, (5, "a", 500), (5, "a", 400), (None, None, 2), (100, None, 7))
    after = store.record()["tables"]["t"]["folders"]
    assert contents(store) == sorted([(i, "a", i) for i in range(100) if i != 5] + [(5, "a", 500), (None, None, 2), (100, None, 7)], key=str)
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 3 and all(after[b] == before[b] for b in before if b not in changed)
    # an earlier state can still be read
    assert (5, "a", 5) in contents(store, version=1) and len(contents(store, version=1)) == 101


def test_an_aborted_transaction_leaves_nothing(spark, store):
    upsert(store, (1, "a", 1))
    tx = store.begin()
    tx.upsert("t", rows(spark, (1, "a", 2)), ["id", "kind"])
    tx.put("watermark", "x", "2020-01-01")
    assert contents(store) == [(1, "a", 1)] and store.values() == {}  # killed here, nothing is seen
    assert store.collect(older_than=0)  # and what it wrote goes
    assert contents(store) == [(1, "a", 1)]


def test_the_second_of_two_writers_conflicts_and_can_begin_again(spark, store):
    upsert(store, (1, "a", 1), (2, "a", 1))
    first, second = store.begin(), store.begin()
    for tx, value in ((first, (1, "a", 10)), (second, (2, "a", 20))):
        tx.upsert("t", rows(spark, value), ["id", "kind"])
    first.commit()
    with pytest.raises(Conflict):
        second.commit()
    assert contents(store) == [(1, "a", 10), (2, "a", 1)]
    upsert(store, (2, "a", 20))
    assert contents(store) == [(1, "a", 10), (2, "a", 20)]


def test_inserts_keep_new_keys_only_and_know_ids(spark, store):
    tx = store.begin()
    tx.insert("h", rows(spark, (1, "a", 1), (1, "a", 1), (2, "a", 1)), ["id", "kind"], ["id"], buckets=4)
    tx.commit()
    tx = store.begin()
    fresh = tx.insert("h", rows(spark, (1, "a", 9), (1, "b", 9), (3, "a", 9)), ["id", "kind"], ["id"], buckets=4)
    tx.commit()
    assert sorted((x.id, x.kind, x.is_new) for x in fresh.collect()) == [(1, "b", False), (3, "a", True)]
    assert contents(store, "h") == [(1, "a", 1), (1, "b", 9), (2, "a", 1), (3, "a", 9)]


def test_logs_are_written_together_when_folders_are_many(spark, store, monkeypatch):
    monkeypatch.setattr("tenderlake.sources.store.FOLDERS", 3)
    for i in range(6):
        store.retried(lambda tx, i=i: tx.append("log", spark.createDataFrame([(i,)], "n int").coalesce(1)))
    assert len(store.record()["tables"]["log"]["folders"]["all"]) <= 4
    assert sorted(x.n for x in store.read("log").collect()) == list(range(6))


def test_collect_removes_replaced_buckets_and_old_records(spark, store):
    for v in range(4):
        upsert(store, *[(i, "a", v) for i in range(20 if v == 0 else 1)])
    gone = store.collect(keep=1, older_than=0)
    assert gone and store.versions() == [4]
    assert contents(store) == sorted([(0, "a", 3)] + [(i, "a", 0) for i in range(1, 20)], key=str)
    assert store.collect(keep=1, older_than=0) == []


def source(spark, *said):
    return lambda first, last: spark.createDataFrame(
        [(i, c, datetime(2020, 1, 1), date.fromisoformat(d)) for i, c, d in said if first <= date.fromisoformat(d) <= last], "row_id string, content string, seen_at timestamp, fact_on date"
    )


def document(n, state):
    return f'{{"id_contrato": "C{n}", "estado_contrato": "{state}", "documento_proveedor": "900{n % 3}", "tipodocproveedor": "Nit", "proveedor_adjudicado": "S{n % 3}"}}'


def state_of(store):
    tables = {t: sorted(map(str, (x.asDict() for x in store.read(t).drop("finished_at").collect()))) for t in ("raw", "contract", "supplier", "variant") if t in store.record()["tables"]}
    log = sorted(str(x.asDict()) for x in store.read("cycle").where("state = 'complete'").drop("finished_at").collect()) if "cycle" in store.record()["tables"] else []
    return tables, log, {k: v["fact_on"] for k, v in store.values().get("watermark", {}).items()}


FIRST = [(f"r{n}", document(n, "open"), f"2020-03-{n:02}") for n in range(1, 10)]
LATER = [("r3", document(3, "shut"), "2020-03-03"), ("r10", document(10, "open"), "2020-03-10"), ("r11", document(11, "open"), "2020-02-20"), ("r1", document(1, "open"), "2020-03-01")]


@pytest.mark.parametrize("cut", ["upsert", "append", "commit"])
def test_a_cycle_cut_off_at_any_step_and_run_again(spark, tmp_path, monkeypatch, cut):
    """Killed before a step, without a chance to clean up, and run again: the tables, watermark and log are those of an undisturbed run."""
    run = lambda s, said, until, **o: cycles.run_cycle(s, "c", source(spark, *said), until, overlap=10, derive=cycles.derive_contracts, buckets=2, now=datetime(2020, 4, 1), **o)
    calm, cut_off = Store(spark, str(tmp_path / "calm")), Store(spark, str(tmp_path / "cut"))
    for s in (calm, cut_off):
        run(s, FIRST, date(2020, 3, 9), start=date(2020, 3, 1))
    before = state_of(cut_off)

    class Killed(BaseException):
        pass

    def die(*a, **b):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(f"tenderlake.sources.store.Transaction.{cut}", die)
        with pytest.raises(Killed):
            run(cut_off, LATER, date(2020, 3, 10))
    assert state_of(Store(spark, cut_off.path)) == before
    entries = [run(s, LATER, date(2020, 3, 10)) for s in (calm, cut_off)]
    assert entries[0] == entries[1] and (entries[0]["seen"], entries[0]["inserted"], entries[0]["new"], entries[0]["changed"]) == (3, 2, 1, 1)
    assert state_of(calm) == state_of(cut_off) and state_of(calm)[2] == {"c": "2020-03-10"}


def test_a_failed_cycle_is_logged_and_leaves_the_watermark(spark, store):
    cycles.run_cycle(store, "c", source(spark, *FIRST), date(2020, 3, 9), start=date(2020, 3, 1), buckets=2)
    with pytest.raises(ZeroDivisionError):
        cycles.run_cycle(store, "c", source(spark, *LATER), date(2020, 3, 10), overlap=10, derive=lambda *a: 1 / 0, buckets=2)
    assert cycles.watermark(store, "c") == date(2020, 3, 9) and store.read("raw").count() == 9
    assert [(x.state, x.cause) for x in store.read("cycle").where("state = 'failed'").collect()] == [("failed", "ZeroDivisionError: division by zero")]


def test_a_supplier_that_loses_its_contracts(spark, store):
    """A contract that goes to another supplier is counted there; the one before keeps its row, with none."""
    kw = {"overlap": 10, "derive": cycles.derive_contracts, "buckets": 2}
    cycles.run_cycle(store, "c", source(spark, ("r1", document(1, "open"), "2020-03-01")), date(2020, 3, 9), start=date(2020, 3, 1), **kw)
    cycles.run_cycle(store, "c", source(spark, ("r1", document(1, "open").replace("9001", "9007"), "2020-03-01")), date(2020, 3, 9), **kw)
    assert sorted((x.supplier_number, x.contracts, x.variants) for x in store.read("supplier").collect()) == [("9001", 0, 0), ("9007", 1, 1)]
    assert sorted((x.supplier_number, x.name, x.contracts) for x in store.read("variant").collect()) == [("9001", "S1", 0), ("9007", "S1", 1)]


def test_windows_from_days_equal_a_recomputation(spark, store):
    """After contracts that change their day, value and supplier; days that nothing touched keep their files."""
    from tenderlake.sources import days

    def dated(n, day, value, who):
        return f'{{"id_contrato": "C{n}", "nit_entidad": "E{n % 2}", "fecha_de_firma": "2020-03-{day:02}T00:00:00.000", "valor_del_contrato": "{value}", "documento_proveedor": "900{who}", "tipodocproveedor": "Nit", "proveedor_adjudicado": "S"}}'

    def run(*said):
        cycles.run_cycle(store, "c", source(spark, *((f"r{n}", dated(n, day, v, w), f"2020-03-{day:02}") for n, day, v, w in said)), date(2020, 3, 31), start=date(2020, 3, 1), derive=days.derive, buckets=16)

    def check():
        made = store.read("contract")
        for first, last in ((date(2020, 3, 1), date(2020, 3, 31)), (date(2020, 3, 4), date(2020, 3, 6))):
            rows = made.where(F.col("signed_on").between(F.lit(first), F.lit(last)))
            want = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("value"), F.lit(0)).cast("double"), F.countDistinct("entity_id"), F.countDistinct("supplier_number")).first()
            assert tuple(days.window(store, first, last).first()) == tuple(want)

    run(*((n, 1 + n % 9, 100 + n, n % 4) for n in range(30)))
    check()
    before = store.record()["tables"]["day"]["folders"]
    run((3, 5, 1000, 3), (4, 5, 104, 9))  # from the 4th to the 5th; another supplier
    check()
    after = store.record()["tables"]["day"]["folders"]
    assert 1 <= sum(after[b] != before.get(b) for b in after) <= 2 < len(after)
    pair = {x.period: x.contracts for x in days.period_pair(store, date(2020, 3, 5), date(2020, 3, 9)).collect()}
    assert pair["now"] + pair["before"] == 30 and set(pair) == {"now", "before"}
