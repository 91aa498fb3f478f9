"""Gap-free grids: both strategies against each other and against brute force."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import complete

DATA = [
    ("A", 1999, 1.0, "x"),
    ("A", 2001, None, "y"),
    (None, 2000, 3.0, "z"),
    ("B", 2005, 4.0, "w"),
]
SCHEMA = "iso3 string, year int, amount double, note string"


def brute_force(data, start, stop, keys=()):
    have = {(k, y) for k, y, *_ in data}
    entities = {k for k, *_ in data} | set(keys)
    out = [(k, y, 0.0 if a is None else a, n) for k, y, a, n in data]
    out += [
        (k, y, 0.0, None)
        for k, y in itertools.product(entities, range(start, stop + 1))
        if (k, y) not in have
    ]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("summarised", [True, False])
def test_fills_gaps_and_old_missing_values(spark, rows, summarised):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = complete(df, ["iso3"], "year", 2000, 2002, {"amount": 0}, summarised=summarised)
    assert out.columns == df.columns
    assert rows(out) == brute_force(DATA, 2000, 2002)


@pytest.mark.parametrize("summarised", [True, False])
def test_foreign_keys(spark, rows, summarised):
    df = spark.createDataFrame(DATA, SCHEMA)
    keys = spark.createDataFrame([("A",), ("C",), ("C",), (None,)], "iso3 string")
    out = complete(
        df, ["iso3"], "year", 2000, 2002, {"amount": 0}, keys=keys, summarised=summarised
    )
    assert rows(out) == brute_force(DATA, 2000, 2002, ["A", "C", None])


@pytest.mark.parametrize("summarised", [True, False])
def test_only_the_range_is_a_key(spark, rows, summarised):
    data = [("PSE", 1990, 5.0), ("PSE", 1980, 1.0)]
    df = spark.createDataFrame(data, "iso3 string, year int, n double")
    gaps = complete(df, [], "year", 1989, 1991, {"n": 0}, summarised=summarised)
    assert rows(gaps, "year", "iso3", "n") == [
        (1980, "PSE", 1.0), (1989, None, 0.0), (1990, "PSE", 5.0), (1991, None, 0.0),
    ]
    kept = complete(
        df, [], "year", 1989, 1991, {"n": 0}, constants={"iso3": "PSE"}, summarised=summarised
    )
    assert kept.where(F.col("iso3").isNull()).count() == 0 and kept.count() == 4


@pytest.mark.parametrize("summarised", [True, False])
def test_empty_input_and_empty_keys(spark, rows, summarised):
    empty = spark.createDataFrame([], "iso3 string, year int, n double")
    assert complete(empty, ["iso3"], "year", 2000, 2002, summarised=summarised).count() == 0
    assert complete(empty, [], "year", 2000, 2002, summarised=summarised).count() == 3


@pytest.mark.parametrize("summarised", [True, False])
def test_dates(spark, rows, summarised):
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame([(1, day, 2)], "user int, day date, n int")
    out = complete(
        df, ["user"], "day", dt.date(2024, 1, 1), dt.date(2024, 1, 3), {"n": 0},
        summarised=summarised,
    )
    assert [tuple(r) for r in out.orderBy("day").collect()] == [
        (1, dt.date(2024, 1, 1), 0), (1, day, 2), (1, dt.date(2024, 1, 3), 0),
    ]


def test_random_tables_agree_and_completing_twice_changes_nothing(spark, rows):
    rng = random.Random(5)
    for _ in range(3):
        pairs = {(rng.choice(["A", "B", "C", None]), rng.randint(1995, 2010)) for _ in range(20)}
        data = [(k, y, rng.choice([None, 1.0, 2.5]), None) for k, y in pairs]
        df = spark.createDataFrame(data, SCHEMA)
        args = (["iso3"], "year", 2000, 2006, {"amount": 0})
        once = complete(df, *args, summarised=True)
        expected = brute_force(data, 2000, 2006)
        assert rows(once) == expected
        assert rows(complete(df, *args)) == expected
        assert rows(complete(once, *args, summarised=True)) == expected


def test_repeated_rows_and_missing_years(spark, rows):
    data = [
        ("A", 2001, 1.0, None), ("A", 2001, 2.0, None), ("A", None, 3.0, None),
        ("D", None, 1.0, None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    expected = brute_force(data, 2000, 2002)
    for summarised in (True, False):
        out = complete(df, ["iso3"], "year", 2000, 2002, {"amount": 0}, summarised=summarised)
        assert rows(out) == expected
