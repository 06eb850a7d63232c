"""Each query with SQL gives the SQL's rows on the smallest data; the llm folder is not needed."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from crateflow.plans import catalogue, library  # noqa: E402, F401

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{t}'")
    return c


def shown(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    f = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(tuple(str(f(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    want = duck.sql(catalogue.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert shown([tuple(r) for r in df.collect()], df.columns) == shown(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).count() > 0
