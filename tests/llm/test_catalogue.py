import os

import pytest

duckdb = pytest.importorskip("duckdb")
from crateflow.llm import catalogue  # noqa: E402

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


def shown(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{t}'")
    df, want = catalogue.QUERIES[name](spark, DIR), c.sql(catalogue.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert shown([tuple(r) for r in df.collect()], df.columns) == shown(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).count() > 0
