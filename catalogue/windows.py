"""Shares, stacked bounds and deflated values."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import operators as op

from .common import Query, money, register, table, year_of

QUERIES: dict[str, Query] = {}


def yearly_rates(spark, sf_dir):
    """(year, rate): the average discount of a year's line items, in percent."""
    lines = table(spark, sf_dir, "lineitem").select(
        year_of("l_shipdate").alias("year"), money("l_discount").alias("discount")
    )
    sums = op.summarise(
        lines, ["year"], {"total": op.lenient_sum("discount"), "n": op.measure_rows()}
    )
    rate = 100 * F.col("total").cast("double") / F.col("n")
    return sums.select("year", F.round(rate, 3).alias("rate"))


RATES = """rates AS (SELECT CAST(year(l_shipdate) AS INT) AS year,
      round(100 * sum(CAST(l_discount AS DECIMAL(18,2)))::DOUBLE / count(*), 3) AS rate
    FROM lineitem GROUP BY 1),
  levels AS (SELECT year, exp(sum(ln(1 + rate / 100)) OVER (ORDER BY year)) AS level FROM rates)"""


def rounded(df, digits=6, *names):
    return df.withColumns({c: F.round(c, digits) for c in names})


@register(
    QUERIES,
    f"""WITH {RATES}, sums AS (
      SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS class,
        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY ALL)
    SELECT s.year, class, total::DOUBLE AS total,
      round(total::DOUBLE / (sum(total) OVER (PARTITION BY s.year))::DOUBLE, 9) AS pct,
      coalesce(sum(total) OVER (below ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        0)::DOUBLE AS ymin,
      (sum(total) OVER (below ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS ymax,
      round(total::DOUBLE * (b.level / l.level), 2) AS real
    FROM sums s LEFT JOIN levels l ON s.year = l.year
    CROSS JOIN (SELECT level FROM levels WHERE year = 2000) b
    WINDOW below AS (PARTITION BY s.year ORDER BY class DESC)""",
)
def win_share_stack_real(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        year_of("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("class"),
        money("o_totalprice").alias("price"),
    )
    sums = op.summarise(orders, ["year", "class"], {"total": op.lenient_sum("price")})
    df = op.add_share(sums, ["year"], {"pct": "total"})
    df = op.add_stack(df, ["year"], "class", "total")
    df = op.deflate(df, "year", {"real": "total"}, yearly_rates(spark, sf_dir), 2000)
    df = df.withColumns({c: F.col(c).cast("double") for c in ("total", "ymin", "ymax")})
    return rounded(rounded(df, 9, "pct"), 2, "real")


@register(
    QUERIES,
    f"""WITH {RATES} SELECT year, year - row_number() OVER (ORDER BY year)::INT AS chain,
      round(level, 9) AS price_level FROM levels""",
)
def win_price_index(spark, sf_dir):
    """Chained price level from yearly rates."""
    return rounded(op.price_index(yearly_rates(spark, sf_dir)), 9, "price_level")


@register(
    QUERIES,
    """WITH sums AS (SELECT CAST(year(o_orderdate) AS INT) AS year,
        sum(CASE WHEN year(o_orderdate) <> 1999 THEN CAST(o_totalprice AS DECIMAL(18,2))
            ELSE 0 END) AS total, o_orderpriority AS class FROM orders GROUP BY ALL)
    SELECT year, class, round(total::DOUBLE / nullif((sum(total) OVER (PARTITION BY year))::DOUBLE,
      0), 9) AS pct FROM sums""",
)
def win_share_of_zero(spark, sf_dir):
    """A year whose total is 0 has no shares."""
    year = year_of("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        year.alias("year"),
        F.col("o_orderpriority").alias("class"),
        F.when(year != 1999, money("o_totalprice")).otherwise(0).alias("price"),
    )
    sums = op.summarise(orders, ["year", "class"], {"total": op.lenient_sum("price")})
    return rounded(op.add_share(sums, ["year"], {"pct": "total"}).drop("total"), 9, "pct")
