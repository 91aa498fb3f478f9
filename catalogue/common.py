"""Tables and fragments that several queries share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import operators as op

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


def register(registry: dict[str, Query], sql: str | None) -> Callable[[Run], Run]:
    """Register a function under its own name, with its SQL twin."""

    def add(run: Run) -> Run:
        registry[run.__name__] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: str | Column) -> Column:
    """Exact two-digit decimal: sums do not depend on row order."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def year_of(col: str) -> Column:
    return F.year(col).cast("int")


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, code): 'N07' for nation 7, NULL for the nations of region 4."""
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.when(
            F.col("n_regionkey") != 4,
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")),
        ).alias("code"),
    )


CODES = """codes AS (
  SELECT n_nationkey, CASE WHEN n_regionkey <> 4
         THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS code
  FROM nation)"""


def orders_by_nation(
    spark: SparkSession, sf_dir: str, columns: dict[str, Column] | None = None
) -> DataFrame:
    """Orders (nation, year, price, or other columns) with the nation of their customer.

    The customer key is unique, so a customer with very many orders is a skewed partition of
    an ordinary join, which adaptive execution splits. Combining the orders of a customer and
    year first would avoid the skew altogether, but it hardly shortens the table and took 1.7
    times as long when measured.
    """
    columns = columns or {"price": money("o_totalprice")}
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        year_of("o_orderdate").alias("year"),
        *[c.alias(name) for name, c in columns.items()],
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return op.recode(orders, "o_custkey", customers, "nation", unique=True).drop("o_custkey")


def summarise_orders(
    spark: SparkSession, sf_dir: str, by: list[str], measures: dict[str, op.Measure]
) -> DataFrame:
    """Measures over ``price`` by ``code`` and perhaps ``year``.

    Rows are combined by nation before they meet the codes.
    """
    codes = country_codes(spark, sf_dir)
    first = ["nation"] + [c for c in by if c != "code"]
    return op.summarise_through(
        orders_by_nation(spark, sf_dir),
        first,
        lambda partial: op.recode(partial, "nation", codes, "code"),
        by,
        measures,
    )


CODED_ORDERS = f"""{CODES}, coded AS (
  SELECT code, CAST(year(o_orderdate) AS INT) AS year,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN codes ON c_nationkey = n_nationkey)"""
