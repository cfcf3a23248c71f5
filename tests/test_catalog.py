"""Every query of the catalogue against its SQL in DuckDB."""

import math

import duckdb
import pytest

from corvane.plans import catalog

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(x):
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return f"{float(x):.5f}"
    return str(x)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = normal(df.columns, df.collect())
    assert got[1]
    sql = catalog.oracle_sql().get(name)
    if sql:
        rel = duck.execute(sql)
        want = normal([d[0] for d in rel.description], rel.fetchall())
        assert got[0] == want[0] and len(got[1]) == len(want[1])
        assert got[1] == want[1]
