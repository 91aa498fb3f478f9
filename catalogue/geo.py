"""Points in polygons. The SQL tests every point against every edge."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import functions as pf
from panelkit import operators as op
from panelkit import sources as src

from .common import CODES, Query, country_codes, money, register, table, year_of

QUERIES: dict[str, Query] = {}


def feature_text(geometry: Column, **properties: Column) -> Column:
    """One GeoJSON feature with a single ring of points as text."""
    named = [v.cast("string").alias(k) for k, v in properties.items()]
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(*named)),
        F.lit(',"geometry":{"type":"Polygon","coordinates":'),
        F.to_json(F.array(geometry)),
        F.lit("}}"),
    )


def nation_areas(spark, sf_dir) -> DataFrame:
    """A concave polygon per nation, 5 apart and 6 wide: neighbours overlap, the last are far out.

    The lower edges lie on y = 0, where there are points, so the boundary rule matters.
    """
    nation = table(spark, sf_dir, "nation")
    x = F.col("n_nationkey") * F.lit(5.0)
    corners = [(0, 0), (6, 0), (6, 40), (3, 20), (0, 40), (0, 0)]
    ring = F.array(*[F.array(x + float(a), F.lit(float(b))) for a, b in corners])
    coded = op.recode(nation, "n_nationkey", country_codes(spark, sf_dir), "iso3")
    texts = coded.select(
        feature_text(
            ring, area_id=F.col("n_nationkey"), iso3=F.col("iso3"), region=F.col("n_regionkey")
        ).alias("feature")
    )
    return src.parse_features(
        texts, "feature", {"area_id": "int", "iso3": "string", "region": "int"}
    )


AREAS = f"""{CODES}, areas AS (
    SELECT n.n_nationkey AS area_id, code AS iso3, n_regionkey AS region,
      n.n_nationkey * CAST(5 AS DOUBLE) AS x
    FROM nation n JOIN codes c ON n.n_nationkey = c.n_nationkey),
  edges AS (
    SELECT area_id, x AS x1, 0::DOUBLE AS y1, x + 6 AS x2, 0::DOUBLE AS y2 FROM areas
    UNION ALL SELECT area_id, x + 6, 0, x + 6, 40 FROM areas
    UNION ALL SELECT area_id, x + 6, 40, x + 3, 20 FROM areas
    UNION ALL SELECT area_id, x + 3, 20, x, 40 FROM areas
    UNION ALL SELECT area_id, x, 40, x, 0 FROM areas)"""


def covered(points: str, edges: str, key: str) -> str:
    """SQL: (x, y, key) of the distinct points of ``points`` covered by a polygon of ``edges``."""
    return f"""SELECT p.x, p.y, e.{key} FROM (SELECT DISTINCT x, y FROM {points}) p
    CROSS JOIN {edges} e GROUP BY p.x, p.y, e.{key}
    HAVING bool_or((x2 - x1) * (p.y - y1) - (p.x - x1) * (y2 - y1) = 0
        AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2)
        AND p.y BETWEEN least(y1, y2) AND greatest(y1, y2))
      OR count(CASE WHEN (y1 > p.y) <> (y2 > p.y) AND
        ((x2 - x1) * (p.y - y1) - (p.x - x1) * (y2 - y1) > 0) = (y2 > y1) THEN 1 END) % 2 = 1"""


def line_incidents(spark, sf_dir) -> DataFrame:
    """Line items as incidents: price and discount give the place, quantity the estimate.

    Some estimates of 1999 are missing.
    """
    year = year_of("l_shipdate")
    known = (F.col("l_returnflag") != "N") | (year != 1999)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("country_id"),
        year.alias("year"),
        (F.col("l_extendedprice") / 1000).alias("longitude"),
        (F.col("l_discount") * 500).alias("latitude"),
        money(F.when(known, F.col("l_quantity"))).alias("best"),
        money("l_quantity").alias("deaths_civilians"),
        F.col("l_linestatus").alias("region"),
    )


INCIDENTS = """incidents AS (
    SELECT l_linenumber AS country_id, CAST(year(l_shipdate) AS INT) AS year,
      l_extendedprice / 1000 AS x, l_discount * 500 AS y,
      CAST(CASE WHEN l_returnflag <> 'N' OR year(l_shipdate) <> 1999 THEN l_quantity END
        AS DECIMAL(18,2)) AS best,
      CAST(l_quantity AS DECIMAL(18,2)) AS deaths FROM lineitem)"""


def vector_points(spark, sf_dir) -> DataFrame:
    """The first two dimensions of a vector as a place."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        F.col("embedding")[0].cast("double").alias("longitude"),
        F.col("embedding")[1].cast("double").alias("latitude"),
    )


def label_diamonds(spark, sf_dir) -> DataFrame:
    """Per label the diamond inside the box of its points; its corners are data coordinates."""
    x, y = F.col("longitude"), F.col("latitude")
    boxes = vector_points(spark, sf_dir).groupBy("label").agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    )
    mid_x, mid_y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    ring = F.array(
        F.array(mid_x, F.col("y0")),
        F.array(F.col("x1"), mid_y),
        F.array(mid_x, F.col("y1")),
        F.array(F.col("x0"), mid_y),
        F.array(mid_x, F.col("y0")),
    )
    texts = boxes.select(feature_text(ring, area=F.col("label")).alias("feature"))
    return src.parse_features(texts, "feature", {"area": "int"})


DIAMONDS = """points AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x,
      CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
  boxes AS (SELECT label AS area, min(x) AS x0, max(x) AS xn, min(y) AS y0, max(y) AS yn,
      (min(x) + max(x)) / 2 AS mx, (min(y) + max(y)) / 2 AS my FROM points GROUP BY label),
  edges AS (
    SELECT area, mx AS x1, y0 AS y1, xn AS x2, my AS y2 FROM boxes
    UNION ALL SELECT area, xn, my, mx, yn FROM boxes
    UNION ALL SELECT area, mx, yn, x0, my FROM boxes
    UNION ALL SELECT area, x0, my, mx, y0 FROM boxes)"""


@register(
    QUERIES,
    f"""WITH {DIAMONDS}, hits AS ({covered("points", "edges", "area")})
    SELECT vec_id, label, p.x AS longitude, p.y AS latitude FROM points p
    WHERE EXISTS (SELECT 1 FROM hits h WHERE h.x = p.x AND h.y = p.y)""",
)
def geo_point_in_polygon(spark, sf_dir):
    """Vectors that lie in the diamond of any label, each once."""
    points = vector_points(spark, sf_dir)
    return op.keep_inside(points, label_diamonds(spark, sf_dir), "area", cell=0.05)


@register(
    QUERIES,
    f"""WITH {DIAMONDS}, hits AS ({covered("points", "edges", "area")})
    SELECT b.area, count(p.vec_id) AS points,
      count(CASE WHEN p.label <> 3 THEN 1 END) AS known,
      CAST(coalesce(sum(CASE WHEN p.label <> 3 THEN p.label END), 0) AS BIGINT) AS total
    FROM boxes b LEFT JOIN hits h ON h.area = b.area
    LEFT JOIN points p ON h.x = p.x AND h.y = p.y GROUP BY b.area""",
)
def geo_left_join_count(spark, sf_dir):
    points = vector_points(spark, sf_dir).withColumn(
        "value", F.when(F.col("label") != 3, F.col("label"))
    )
    counted = op.count_in_polygons(
        label_diamonds(spark, sf_dir), points, "area",
        {"points": op.measure_rows(), "known": op.measure_present("value"),
         "total": op.lenient_sum("value")},
        cell=0.05,
    )
    return counted.select("area", "points", "known", "total")


@register(
    QUERIES,
    f"""WITH {AREAS}, {INCIDENTS},
    places AS (SELECT x, y, count(*) AS n FROM incidents GROUP BY ALL),
    hits AS ({covered("incidents", "edges", "area_id")})
    SELECT a.area_id, a.iso3, a.region, coalesce(sum(n), 0)::BIGINT AS events
    FROM areas a LEFT JOIN hits h ON h.area_id = a.area_id
    LEFT JOIN places p ON h.x = p.x AND h.y = p.y GROUP BY ALL""",
)
def geo_overlapping_areas(spark, sf_dir):
    """Incidents per nation area, edges included; far areas count 0."""
    counted = op.count_in_polygons(
        nation_areas(spark, sf_dir), line_incidents(spark, sf_dir), "area_id",
        {"events": op.measure_rows()}, cell=2.0,
    )
    return counted.select("area_id", "iso3", "region", "events")


@register(
    QUERIES,
    f"""WITH {AREAS}, places AS (SELECT c_custkey, CAST(c_acctbal / 100 AS DOUBLE) AS x,
        CAST(c_nationkey AS DOUBLE) AS y FROM customer),
    hits AS ({covered("places", "edges", "area_id")})
    SELECT a.area_id, a.iso3, c_custkey FROM areas a LEFT JOIN hits h ON h.area_id = a.area_id
    LEFT JOIN places p ON h.x = p.x AND h.y = p.y""",
)
def geo_left_join_rows(spark, sf_dir):
    """One row per area and customer in it, and a row for each area without any."""
    places = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 100).alias("longitude"),
        F.col("c_nationkey").cast("double").alias("latitude"),
    )
    joined = op.spatial_left_join(
        nation_areas(spark, sf_dir), places, "area_id",
        cell=5.0, carry=["area_id", "iso3"],
    )
    return joined.select("area_id", "iso3", "c_custkey")


@register(
    QUERIES,
    """WITH places AS (SELECT l_extendedprice / 500 AS longitude FROM lineitem)
    SELECT count(*) AS n, max(longitude) AS east FROM places
    WHERE longitude BETWEEN -180 AND 180""",
)
def geo_checked_points(spark, sf_dir):
    """Coordinates out of range are dropped on request (by default they fail the query)."""
    places = table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 500).alias("longitude"),
        F.lit(0.0).alias("latitude"),
    )
    kept = op.point_columns(places, bad="drop")
    return kept.agg(pf.n_rows().alias("n"), F.max("longitude").alias("east"))


@register(
    QUERIES,
    """WITH places AS (SELECT CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / 500 END AS x
      FROM lineitem)
    SELECT count(*) AS points, count(CASE WHEN x IS NULL THEN 1 END) AS missing,
      count(CASE WHEN x NOT BETWEEN -180 AND 180 THEN 1 END) AS out_of_range FROM places""",
)
def geo_point_problems(spark, sf_dir):
    """How many coordinates are missing or out of range."""
    places = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") / 500).alias("longitude"),
        F.lit(0.0).alias("latitude"),
    )
    return op.point_problems(places)


@register(
    QUERIES,
    f"""WITH {AREAS}, {INCIDENTS},
    places AS (SELECT x, y, count(*) AS n FROM incidents GROUP BY ALL),
    hits AS ({covered("incidents", "edges", "area_id")})
    SELECT a.area_id, CASE WHEN a.region < 3 THEN a.region END AS shared,
      coalesce(sum(n), 0)::BIGINT AS events
    FROM areas a LEFT JOIN hits h ON h.area_id = a.area_id
    LEFT JOIN places p ON h.x = p.x AND h.y = p.y GROUP BY ALL""",
)
def geo_repeated_ids(spark, sf_dir):
    """Areas whose id is shared by many, or missing, count on their own."""
    areas = nation_areas(spark, sf_dir).withColumn(
        "shared", F.when(F.col("region") < 3, F.col("region"))
    )
    counted = op.count_in_polygons(
        areas, line_incidents(spark, sf_dir), "shared",
        {"events": op.measure_rows()}, cell=2.0,
    )
    return counted.select("area_id", "shared", "events")


def _checked(run) -> str:
    """What a spatial job does with its points: a number of rows, or the reason it failed for."""
    try:
        return f"rows: {run().count()}"
    except PySparkException as error:
        found = re.search("bad coordinates", str(error))
        if not found:
            raise
        return found.group()


@register(
    QUERIES,
    f"""WITH {AREAS}, flagged AS (
      SELECT l_returnflag AS flag, l_extendedprice / 1000 AS x,
        CASE WHEN l_returnflag <> 'N' THEN l_discount * 500 END AS y FROM lineitem),
    points AS (SELECT flag, CASE WHEN flag = 'R' AND x > 60 THEN x + 200 ELSE x END AS x, y
      FROM flagged),
    judged AS (SELECT flag, bool_or(x IS NULL OR y IS NULL OR x > 180) AS wrong
      FROM points GROUP BY flag),
    places AS (SELECT x, y, count(*) AS n FROM points WHERE flag = 'A' GROUP BY ALL),
    hits AS ({covered("places", "edges", "area_id")}),
    kept AS (SELECT coalesce(sum(n), 0)::BIGINT AS n FROM places p
      WHERE EXISTS (SELECT 1 FROM hits h WHERE h.x = p.x AND h.y = p.y)),
    pairs AS (SELECT count(*) + (SELECT count(*) FROM areas a
        WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.area_id = a.area_id)) AS n
      FROM hits h JOIN points p ON p.flag = 'A' AND p.x = h.x AND p.y = h.y),
    jobs AS (SELECT 'keep_inside' AS job, (SELECT n FROM kept) AS n, 0 AS n_none
      UNION ALL SELECT 'count_in_polygons', (SELECT count(*) FROM areas), 0
      UNION ALL SELECT 'spatial_left_join', (SELECT n FROM pairs), 0)
    SELECT flag, job, areas AS polygons, CASE WHEN wrong THEN 'bad coordinates'
        ELSE 'rows: ' || CASE WHEN areas = 'none' THEN n_none ELSE n END END AS outcome
    FROM judged CROSS JOIN jobs CROSS JOIN (SELECT unnest(['nations', 'none']) AS areas)
    WHERE (areas = 'none') = (job = 'spatial_left_join')""",
)
def geo_bad_points_reported(spark, sf_dir):
    """Stored points by return flag: sound ones are counted, a missing or far one fails each job.

    The points of N have no latitude, those of R a longitude beyond 180 where the price is high.
    """
    x, flag = F.col("l_extendedprice") / 1000, F.col("l_returnflag")
    points = table(spark, sf_dir, "lineitem").select(
        flag.alias("flag"),
        F.when((flag == "R") & (x > 60), x + 200).otherwise(x).alias("longitude"),
        F.when(flag != "N", F.col("l_discount") * 500).alias("latitude"),
    )
    stored, areas = op.settle(points), op.settle(nation_areas(spark, sf_dir))
    number = {"events": op.measure_rows()}
    found = []
    for flag in sorted(r[0] for r in stored.select("flag").distinct().collect()):
        part = stored.where(F.col("flag") == flag).drop("flag")
        for name, shapes in (("nations", areas), ("none", areas.where("area_id < 0"))):
            jobs = {
                "keep_inside": lambda: op.keep_inside(part, shapes, "area_id", cell=5.0),
                # the filter reads the numbers; a mere count of polygons needs no points
                "count_in_polygons": lambda: op.count_in_polygons(
                    shapes, part, "area_id", number, cell=5.0).where("events >= 0"),
                "spatial_left_join": lambda: op.spatial_left_join(
                    shapes, part, "area_id", cell=5.0, carry=["area_id"]),
            }
            found += [
                (flag, job, name, _checked(run))
                for job, run in jobs.items()
                if (name == "none") == (job == "spatial_left_join")
            ]
    return spark.createDataFrame(found, "flag string, job string, polygons string, outcome string")
