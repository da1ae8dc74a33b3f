"""Every query of the catalogue against its oracle on the smallest tables."""

import duckdb
import pytest

from tenderlake.plans import catalog, ingestion, panel, reports

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_reports_are_registered():
    assert len(reports.NAMES) > 50 and {*reports.NAMES, *ingestion.NAMES, *panel.NAMES} <= set(catalog.ORACLES)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    result = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
