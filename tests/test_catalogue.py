"""Every registered query against its SQL twin in DuckDB."""

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as contract  # noqa: E402
from catalogue import REGISTRY  # noqa: E402

SF_DIR = Path(os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001"))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def exact(value):
    """Type and value as text, so that 1 and 1.0, or 0.0 and -0.0, are told apart."""
    if isinstance(value, dt.datetime):
        value = value.date()
    return f"{type(value).__name__}:{value!r}"


def as_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(exact(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, database, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    cursor = database.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got, expected = as_rows(df.columns, df.collect()), as_rows(columns, cursor.fetchall())
    assert len(got) == len(expected) > 0
    assert got == expected


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
