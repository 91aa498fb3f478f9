"""Gap-free grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelkit import operators as op

from .common import CODED_ORDERS, CODES, Query, country_codes, money, register
from .common import summarise_orders, table, year_of

QUERIES: dict[str, Query] = {}


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}, agg AS (
      SELECT code, year, count(*) AS n, sum(price) AS total FROM coded GROUP BY code, year),
    grid AS (SELECT k.code, y.year FROM (SELECT DISTINCT code FROM agg) k
      CROSS JOIN (SELECT CAST(unnest(range(1996, 2004)) AS INT) AS year) y)
    SELECT coalesce(g.code, a.code) AS code, coalesce(g.year, a.year) AS year,
      coalesce(n, 0) AS n, coalesce(total, 0)::DOUBLE AS total
    FROM grid g FULL JOIN agg a ON g.code IS NOT DISTINCT FROM a.code AND g.year = a.year""",
)
def rsh_complete_grid(spark, sf_dir):
    """Code x 1996..2003: a missing code is an entity, and the rows of 1995 stay."""
    measures = {"n": op.measure_rows(), "total": op.lenient_sum("price")}
    panel = summarise_orders(spark, sf_dir, ["code", "year"], measures)
    panel = panel.withColumn("total", F.col("total").cast("double"))
    return op.complete(
        panel, ["code"], "year", 1996, 2003, {"n": 0, "total": 0}, summarised=True
    )


@register(
    QUERIES,
    """WITH agg AS (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
    grid AS (SELECT k.user_id, d.day FROM (SELECT DISTINCT user_id FROM agg) k
      CROSS JOIN (SELECT CAST(unnest(range(DATE '2023-12-30', DATE '2024-02-02',
        INTERVAL 1 DAY)) AS DATE) AS day) d)
    SELECT coalesce(g.user_id, a.user_id) AS user_id, coalesce(g.day, a.day) AS day,
      coalesce(n, 0) AS n
    FROM grid g FULL JOIN agg a ON g.user_id = a.user_id AND g.day = a.day""",
)
def rsh_complete_days(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    counts = op.summarise(events, ["user_id", "day"], {"n": op.measure_rows()})
    return op.complete(
        counts, ["user_id"], "day", dt.date(2023, 12, 30), dt.date(2024, 2, 1), {"n": 0},
        summarised=True,
    )


@register(
    QUERIES,
    """WITH ev AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day,
        CASE WHEN event_type <> 'view' THEN value END AS value FROM events),
    grid AS (SELECT k.user_id, d.day FROM (SELECT DISTINCT user_id FROM ev) k
      CROSS JOIN (SELECT CAST(unnest(range(DATE '2023-12-30', DATE '2024-02-02',
        INTERVAL 1 DAY)) AS DATE) AS day) d)
    SELECT event_id, coalesce(g.user_id, e.user_id) AS user_id, coalesce(g.day, e.day) AS day,
      coalesce(value, 0) AS value
    FROM grid g FULL JOIN ev e ON g.user_id = e.user_id AND g.day = e.day""",
)
def rsh_complete_raw_rows(spark, sf_dir):
    """Raw events, many per user and day, with rows for the days without any."""
    value = F.when(F.col("event_type") != "view", F.col("value"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), value.alias("value")
    )
    return op.complete(
        events, ["user_id"], "day", dt.date(2023, 12, 30), dt.date(2024, 2, 1), {"value": 0}
    )


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}, agg AS (
      SELECT code, year, count(*) AS n FROM coded WHERE code IS NOT NULL GROUP BY code, year),
    keys AS (SELECT code FROM agg UNION SELECT s_name FROM supplier
      UNION SELECT code FROM supplier JOIN codes ON s_nationkey = n_nationkey),
    grid AS (SELECT k.code, y.year FROM keys k
      CROSS JOIN (SELECT CAST(unnest(range(1994, 2003)) AS INT) AS year) y)
    SELECT g.code, g.year, coalesce(n, 0) AS n
    FROM grid g LEFT JOIN agg a ON g.code IS NOT DISTINCT FROM a.code AND g.year = a.year""",
)
def rsh_complete_foreign(spark, sf_dir):
    """Keys of the panel and of another table: the codes of suppliers, and their names."""
    panel = summarise_orders(spark, sf_dir, ["code", "year"], {"n": op.measure_rows()})
    panel = panel.where(F.col("code").isNotNull())
    suppliers = table(spark, sf_dir, "supplier")
    coded = op.recode(suppliers, "s_nationkey", country_codes(spark, sf_dir), "code")
    named = suppliers.select(F.col("s_name").alias("code"))
    return op.complete(
        panel, ["code"], "year", 1994, 2002, {"n": 0},
        keys=op.bind_rows(coded.select("code"), named), summarised=True,
    )


_ONE = """agg AS (SELECT 'PSE' AS iso3, CAST(year(l_shipdate) AS INT) AS year, count(*) AS events,
      CASE WHEN count(*) = count(best) THEN sum(best) END::DOUBLE AS fatalities
    FROM (SELECT l_shipdate, CAST(CASE WHEN year(l_shipdate) <> 1997 THEN l_quantity END
          AS DECIMAL(18,2)) AS best FROM lineitem) GROUP BY 2),
    grid AS (SELECT CAST(unnest(range(1989, 2023)) AS INT) AS year)"""


def _one_entity(spark, sf_dir):
    year = year_of("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit("PSE").alias("iso3"),
        year.alias("year"),
        money(F.when(year != 1997, F.col("l_quantity"))).alias("best"),
    )
    measures = {"events": op.measure_rows(), "fatalities": op.complete_sum("best")}
    sums = op.summarise(lines, ["iso3", "year"], measures)
    return sums.withColumn("fatalities", F.col("fatalities").cast("double"))


@register(
    QUERIES,
    f"""WITH {_ONE} SELECT iso3, coalesce(g.year, a.year) AS year, coalesce(events, 0) AS events,
      coalesce(fatalities, 0) AS fatalities FROM grid g FULL JOIN agg a ON g.year = a.year""",
)
def rsh_complete_partial(spark, sf_dir):
    """Only the year is a key: gap years have no entity, and a missing sum becomes 0."""
    return op.complete(
        _one_entity(spark, sf_dir), [], "year", 1989, 2022, {"events": 0, "fatalities": 0},
        summarised=True,
    )


@register(
    QUERIES,
    f"""WITH {_ONE} SELECT coalesce(iso3, 'PSE') AS iso3, coalesce(g.year, a.year) AS year,
      coalesce(events, 0) AS events, coalesce(fatalities, 0) AS fatalities
    FROM grid g FULL JOIN agg a ON g.year = a.year""",
)
def rsh_complete_partial_constant(spark, sf_dir):
    """The same with the entity kept in the gap years."""
    return op.complete(
        _one_entity(spark, sf_dir), [], "year", 1989, 2022, {"events": 0, "fatalities": 0},
        constants={"iso3": "PSE"}, summarised=True,
    )


@register(
    QUERIES,
    f"""WITH {CODES} SELECT code FROM customer JOIN codes ON c_nationkey = n_nationkey
    UNION SELECT s_name FROM supplier""",
)
def agg_distinct_keys(spark, sf_dir):
    """Distinct keys of two tables, the missing one included."""
    customers = op.recode(
        table(spark, sf_dir, "customer").select("c_nationkey").distinct(),
        "c_nationkey", country_codes(spark, sf_dir), "code",
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("code"))
    return op.distinct_rows(op.bind_rows(customers.select("code"), suppliers))
