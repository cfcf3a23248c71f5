"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from corvane.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    rel = c.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(rel.fetchall())
