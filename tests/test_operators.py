import json
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import values as V
from tenderlake.operators import incremental, normalize, publish, quality, raw, rules, windows


def raw_rows(spark, docs):
    rows = [(f"r{i:03}", json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "row_id string, content string")


def test_identity_and_hash(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", " ", "c"), (" ", "b", "c"), (None, "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(raw.identity(F.col("x"), F.col("y"), F.col("z"))).collect()] == ["a|b|c", "a", None, None]
    docs = spark.createDataFrame([('{"b":"1","a":"é",":id":"x"}',), ('{":id":"y","a":"é","b":"1"}',)], "c string")
    hashes = {tuple(r) for r in docs.select(raw.canonical(F.col("c")), raw.content_hash(F.col("c"))).collect()}
    assert len(hashes) == 1 and next(iter(hashes))[0] == '{"a":"é","b":"1"}'


def test_append_is_idempotent(spark):
    key = ["row_id", "hash"]
    page = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1")], "row_id string, hash string")
    none = page.limit(0)
    first = raw.append_new(none, page, key, "row_id")
    assert sorted((r.row_id, r.is_new) for r in first.collect()) == [("a", True), ("b", True)]
    assert raw.append_new(first.drop("is_new"), page, key, "row_id").count() == 0
    more = spark.createDataFrame([("a", "2"), ("c", "1")], "row_id string, hash string")
    assert sorted((r.row_id, r.is_new) for r in raw.append_new(page, more, key, "row_id").collect()) == [("a", False), ("c", True)]


def test_rekey(spark):
    rows = spark.createDataFrame([("1", "h", 1), ("2", "h", 2), ("3", "g", 3)], "id string, hash string, at int").withColumn("key", F.when(F.col("id") == "3", "y").otherwise("x"))
    made = raw.rekeyed(rows, F.col("key"), "id", [F.desc("at")])
    assert sorted((r.id, r.at) for r in made.collect()) == [("x", 2), ("y", 3)]
    assert not raw.rekey_matches(rows, made, "id").first().matches


def test_normalization_and_links(spark):
    procs = [{"id_del_proceso": "P1", "id_del_portafolio": "B1", "adjudicado": "Si"}] * 21 + [{"id_del_proceso": "P2", "id_del_portafolio": "B2"}, {"entidad": "x"}]
    table = normalize.processes(raw_rows(spark, procs))
    assert normalize.rejected(raw_rows(spark, procs), "id_del_proceso").first().rejected == 1
    one = normalize.one_per_process(table)
    assert sorted((r.process_id, r.row_id, r.awarded) for r in one.collect()) == [("P1", "r020", True), ("P2", "r021", None)]
    cons = [
        {"id_contrato": "C1", "proceso_de_compra": "B1", "valor_del_contrato": "8054481856630300", "tipodocproveedor": "NIT", "documento_proveedor": "900.123.456", "es_grupo": "No", "fecha_de_firma": "2026-08-07T00:00:00.000", "orden": "Territorial"},
        {"id_contrato": "C2", "proceso_de_compra": "B9", "es_grupo": "Sí", "documento_proveedor": "No Definido", "departamento": "Bogotá"},
        {"id_contrato": "C3", "valor_del_contrato": "x", "documento_proveedor": "11111"}, {"valor_del_contrato": "1"},
    ]
    c = normalize.linked(normalize.contracts(raw_rows(spark, cons)), table)
    got = {r.contract_id: r for r in c.collect()}
    assert (got["C1"].process_id, got["C1"].supplier_number, got["C1"].provisional, got["C1"].out_of_scale, got["C1"].admin_level) == ("P1", "900123456", False, True, "TERRITORIAL")
    assert (got["C2"].supplier_number, got["C2"].provisional, got["C2"].value, got["C2"].out_of_scale) == ("C2", True, None, None)
    assert (got["C3"].supplier_type, got["C3"].provisional) == (None, None)
    s = normalize.link_summary(c).first()
    assert (s.contracts, s.linked, s.orphans, s.without_key, s.orphan_share) == (3, 1, 1, 1, 0.5)


def test_suppliers(spark):
    rows = [("NIT", "1", "B", False), ("NIT", "1", "B", False), ("NIT", "1", "A", False), ("NIT", "1", "A", False), ("CC", "1", "Z", False), (None, None, "Q", None)]
    c = spark.createDataFrame(rows, "supplier_type string, supplier_number string, supplier_name string, provisional boolean")
    got = {(r.supplier_type, r.supplier_number): (r.main_name, r.contracts, r.variants) for r in normalize.suppliers(normalize.supplier_variants(c)).collect()}
    assert got == {("NIT", "1"): ("A", 4, 2), ("CC", "1"): ("Z", 1, 1)}


def test_territory(spark):
    departments = spark.createDataFrame([("11", "Bogotá, D.C."), ("05", "Antioquia")], "code string, name string")
    towns = spark.createDataFrame([("05001", "Medellín"), ("11001", "Bogotá, D.C."), ("11002", "Medellin")], "code string, name string")
    c = spark.createDataFrame([("ANTIOQUIA ", "medellín"), ("nowhere", "Medellín"), (None, None)], "department_name string, municipality string")
    got = sorted((tuple(r) for r in normalize.with_municipality(normalize.with_department(c, departments), towns).select("department_code", "department_name", "municipality_code").collect()), key=str)
    assert got == [("05", "Antioquia", "05001"), (None, "NOWHERE", None), (None, None, None)]
    assert normalize.shared_names(towns).first().name == "MEDELLIN"


def test_errata_take_the_latest_that_qualifies(spark):
    rows = [("P", 1, True, 10, 1000), ("P", 2, False, 10, 10), ("Q", 1, True, 10, 10001), ("Q", 2, True, 10, 100), ("R", 1, True, 0, 5), ("S", 1, True, 10, 1020)]
    snaps = spark.createDataFrame(rows, "process_id string, at int, awarded boolean, base int, award int")
    assert [(r.process_id, r.zeros) for r in quality.errata(snaps, [F.desc("at")]).collect()] == [("P", 2)]
    c = spark.createDataFrame([("P",), ("Q",), (None,)], "process_id string")
    assert sorted(str(r[0]) for r in quality.publishable(c, quality.errata(snaps, [F.desc("at")])).collect()) == ["None", "Q"]


def test_intervals(spark):
    d = lambda k: date(2026, 1, k)
    rows = [("p", 1, d(1), d(10), "x"), ("p", 2, d(10), d(20), "y"), ("p", 3, d(11), d(12), "x"), ("p", 4, d(21), date(2026, 3, 5), "x"), ("p", 5, date(2026, 2, 1), date(2026, 4, 1), None), ("q", 6, d(1), d(9), "z")]
    df = spark.createDataFrame(rows, "k string, i int, s date, e date, o string")
    pairs = windows.overlaps(df, "k", "i", "s", "e", "o")
    assert sorted((r.a_id, r.b_id, r.days) for r in pairs.collect()) == [(1, 2, 1), (2, 3, 2), (4, 5, 33)]
    assert {r.k: r.peak for r in windows.peak_concurrency(df, "k", "s", "e").collect()} == {"p": 2, "q": 1}
    assert {r.k: r.others for r in windows.partners(df, "k", "s", "e", "o").collect()} == {"p": 2}


def test_partners_against_all_pairs(spark):
    rng = random.Random(5)
    day = lambda: date(2026, 1, 1) + timedelta(rng.randrange(120))
    rows = [(rng.choice(["p", "q", "r", None]), i, day(), day(), rng.choice(["x", "y", "z", "u", "v", None])) for i in range(80)]
    rows += [("s", 100, date(2026, 1, 1), date(2026, 1, 5), "x"), ("s", 101, date(2026, 1, 5), date(2026, 1, 5), "x"), ("s", 102, date(2026, 1, 6), date(2026, 1, 9), "y")]
    wanted = {}
    for a in rows:
        for b in rows:
            if a[0] is not None and a[0] == b[0] and a[4] != b[4] and max(a[2], b[2]) <= min(a[3], b[3]):
                wanted.setdefault(a[0], set()).add(a[4])
    df = spark.createDataFrame(rows, "k string, i int, s date, e date, o string")
    assert {r.k: r.others for r in windows.partners(df, "k", "s", "e", "o").collect()} == {k: len(v - {None}) for k, v in wanted.items()}
    assert windows.partners(df.limit(0), "k", "s", "e", "o").count() == 0


def groups(spark, **changes):
    row = {"entity_id": "e", "month": date(2026, 7, 1), "contracts": 6, "total": Decimal(290_911_738), "ceiling": Decimal(73_526_697), "p95": 70e6, "entity_contracts": 40} | changes
    return spark.createDataFrame([tuple(row.values())], "entity_id string, month date, contracts int, total decimal(38,2), ceiling decimal(38,2), p95 double, entity_contracts int")


@pytest.mark.parametrize(
    ("changes", "verdict"),
    [({}, "fires"), ({"total": Decimal(73_526_697)}, "quiet"), ({"contracts": 1}, "quiet"), ({"ceiling": Decimal(44_118_060_000), "p95": 50e6}, "blind"), ({"entity_contracts": 4}, "blind"), ({"ceiling": None}, "blind"),
     ({"ceiling": Decimal(100_000_000), "total": Decimal(195_000_000)}, "quiet"), ({"ceiling": Decimal(40_000_000), "total": Decimal(116_400_001), "p95": 4e7}, "fires")],
)
def test_splitting(spark, changes, verdict):
    assert rules.splitting_verdict(groups(spark, **changes)).first().verdict == verdict


def test_calibration(spark):
    df = spark.createDataFrame([("fires",), ("quiet",), ("blind",)], "verdict string")
    assert tuple(rules.calibration(df).first()) == (2, 1, 1, 0.5)
    assert rules.calibration(df.where("verdict = 'blind'")).first().rate is None


def test_rule_states_and_identities(spark):
    rule = rules.Rule("splitting").with_thresholds({"cut": Decimal("1.420")})
    with pytest.raises(ValueError):
        rule.with_thresholds({"cut": Decimal("1.42")})
    with pytest.raises(ValueError):
        rule.move("active")
    rule = rule.move("calibration")
    with pytest.raises(ValueError):
        rule.move("active")
    assert rule.calibrated_on(10).move("active").state == "active"
    with pytest.raises(TypeError):
        rules.digest({"x": 1.5})
    df = spark.createDataFrame([("c1", 2, "a"), ("c1", 2, "b"), ("c2", 2, "a")], "id string, n int, noise string")
    ids = [r[0] for r in df.select(rules.alert_id(F.col("id"), "contratos", "splitting", 1, F.struct("n"))).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_single_bidder_counts_none_but_not_unknown(spark):
    df = spark.createDataFrame([("a", True, "Licitación pública", 1), ("b", True, "LICITACION PUBLICA", 0), ("c", True, "Licitación pública", None), ("d", False, "Licitación pública", 1), ("e", True, "Directa", 1)], "process_id string, awarded boolean, modality string, bidders int")
    assert sorted(r.process_id for r in rules.single_bidder(df, ["LICITACION PUBLICA"]).collect()) == ["a", "b"]


def test_cycles(spark):
    assert incremental.ingest_range(date(2026, 9, 14), date(2026, 9, 20)) == (date(2026, 7, 31), date(2026, 9, 20))
    for bad in ((None, date(2026, 9, 1)), (date(2026, 12, 1), date(2026, 9, 1))):
        with pytest.raises(ValueError):
            incremental.ingest_range(*bad)
    rows = spark.createDataFrame([(date(2026, 7, 31), True), (date(2026, 7, 31), False), (date(2026, 9, 1), True)], "fact_on date, is_new boolean")
    c = incremental.cycle(rows, 10, date(2026, 8, 15), date(2026, 7, 31)).first()
    assert (c.seen, c.inserted, c.duplicates, c.new, c.changed, c.recovered, c.short_window, c.changed_on_edge) == (10, 3, 7, 2, 1, 2, 1, 1)
    t = lambda k: datetime(2026, 9, k)
    log = spark.createDataFrame([("c", t(1), "complete", True, 5000, 4900), ("c", t(2), "failed", True, 0, 0), ("c", t(3), "complete", True, 400, 390), ("c", t(4), "complete", True, 2000, 100)], "dataset string, finished_at timestamp, state string, derived boolean, seen long, duplicates long")
    got = [(r.changed_everything, r.almost_nothing) for r in incremental.with_alarms(log).orderBy("finished_at").collect()]
    assert got == [(False, False), (False, False), (False, True), (True, False)]
    marks = spark.createDataFrame([("c", date(2026, 9, 1), t(1))], "dataset string, fact_on date, updated_at timestamp")
    older = spark.createDataFrame([("c", date(2026, 8, 1), t(2))], "dataset string, fact_on date, updated_at timestamp")
    assert tuple(incremental.advanced(marks, older).first()) == ("c", date(2026, 9, 1), t(2))
    assert incremental.schema_check({"a", "b", ":@computed_region_x"}, {"a"}) == {"b"}
    with pytest.raises(ValueError, match="missing"):
        incremental.schema_check({"a"}, {"a", "z"})
    bad = spark.createDataFrame([("failed", None, 5, 3, 1, date(2026, 2, 1), date(2026, 1, 1))], "state string, cause string, seen long, inserted long, duplicates long, first date, last date")
    assert sorted(r.rule for r in incremental.violations(bad).collect()) == ["failed_without_cause", "range", "sum"]


def test_publication(spark):
    posts = spark.createDataFrame([("fine https://x.org/123456789",), ("La corrupción de 12345678",), ("x" * 281,), ("  ",), (None,)], "text string")
    got = [(r.digits, r.words, r.too_long, r.blank) for r in publish.findings(posts).collect()]
    assert got == [(0, 0, False, False), (1, 1, False, False), (0, 0, True, False), (0, 0, False, True), (0, 0, False, True)]
    yes = spark.createDataFrame([(True,)], "ok boolean")
    contracts = spark.createDataFrame([(True, False), (None, True)], "out_of_scale boolean, published boolean")
    errata, reviewed = spark.createDataFrame([("P",), ("Q",)], "process_id string"), spark.createDataFrame([("P",)], "process_id string")
    gates = publish.gates(yes, contracts, errata, reviewed, yes, posts.limit(1)).orderBy("n").collect()
    assert [(g.n, g.green) for g in gates] == [(1, True), (2, True), (3, False), (4, True), (5, True), (6, True)]


def test_canonical_documents(spark):
    same = ['{"b": {"y": [1, {"q": 1, "p": null}], "x": "é"}, "a": 1, ":id": 7}', '{ ":id":8,"a":1,"b":{"x":"é","y":[1,{"p":null,"q":1}]}}']
    others = ['{"a":"1","b":{"x":"é","y":[1,{"p":null,"q":1}]}}', '{"a":1,"b":{"x":"é","y":[{"p":null,"q":1},1]}}', '{"a":true}', '{"a":null}', '{"a\\"b":"c\\nd"}', "{}"]
    said = [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(same + others)], "i int, c string").orderBy("i").select(raw.canonical(F.col("c"))).collect()]
    assert said[0] == said[1] == '{"a":1,"b":{"x":"é","y":[1,{"p":null,"q":1}]}}'
    assert said[2:] == ['{"a":"1","b":{"x":"é","y":[1,{"p":null,"q":1}]}}', '{"a":1,"b":{"x":"é","y":[{"p":null,"q":1},1]}}', '{"a":true}', '{"a":null}', '{"a\\"b":"c\\nd"}', "{}"]


def test_words_and_documents_before_publication(spark):
    texts = ["Hay irregularidades", "un FRAUDULENTO", "robo y criminal", "Cédula de ciudadanía No. 12345678", "NIT 900123456", "pasaporte ••••678", "permiso  por protección: 1234", "cédulas: ver anexo 20261"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").orderBy("i")
    assert [r[0] for r in df.select(F.size(publish.guilt_words(F.col("text")))).collect()] == [1, 1, 0, 0, 0, 0, 0, 0]
    assert [r[0] for r in df.select(publish.person_documents(F.col("text"))).collect()] == [[], [], [], ["12345678"], [], [], [], ["20261"]]
    assert [r[0] for r in spark.createDataFrame([("Čapek Şő Ὀδ ﬁ ǖ",)], "t string").select(V.normalized(F.col("t"))).collect()] == ["CAPEK SO ΟΔ FI U"]


def test_ceilings_need_a_source(spark):
    schema = "concept string, scope string, value int, unit string, effective_on date, source string"
    good = spark.createDataFrame([("c", "s", 1, "u", date(2026, 1, 1), "law"), ("c", "s", 2, "u", date(2026, 7, 1), "law")], schema)
    rows = spark.createDataFrame([("s", date(2025, 1, 1)), ("s", date(2026, 6, 30)), ("s", date(2026, 7, 1)), ("t", date(2026, 7, 1))], "scope string, day date")
    assert [r.ceiling for r in rules.with_ceiling(rows, good, "c", "scope", "day").orderBy("scope", "day").collect()] == [None, 1, 2, None]
    with pytest.raises(Exception, match="a ceiling needs"):
        rules.normative(good.withColumn("source", F.lit(" "))).collect()
