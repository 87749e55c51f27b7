"""Every registered query with an SQL gives the same rows as DuckDB on the smallest tables."""

import duckdb
import pytest

from panelkit.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted(str(tuple(r)) for r in got.select(*cols).collect())
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(str(tuple(r[i] for i in at)) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_models_give_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
