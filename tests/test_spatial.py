"""Points in polygons against an independent loop over all pairs."""

import json
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit import operators as op
from panelkit import sources as src
from panelkit.operators.spatial import _crowded_cells

# A concave ring, a square with a hole, an overlapping square, two far parts, and an empty spot.
SHAPES = {
    "concave": {"type": "Polygon", "coordinates": [
        [[0, 0], [8, 0], [8, 8], [4, 4], [0, 8], [0, 0]]]},
    "hole": {"type": "Polygon", "coordinates": [
        [[-6, -6], [2, -6], [2, 2], [-6, 2], [-6, -6]],
        [[-4, -4], [-4, 0], [0, 0], [0, -4], [-4, -4]]]},
    "parts": {"type": "MultiPolygon", "coordinates": [
        [[[10, 10], [12, 10], [12, 12], [10, 12]]],
        [[[-10, -10], [-8, -10], [-9, -7], [-10, -10]]]]},
    "empty": {"type": "Polygon", "coordinates": [[[50, 50], [51, 50], [51, 51], [50, 50]]]},
}


def rings_of(geometry):
    parts = geometry["coordinates"]
    parts = [parts] if geometry["type"] == "Polygon" else parts
    return [ring for part in parts for ring in part]


def inside(geometry, x, y):
    crossings = 0
    for ring in rings_of(geometry):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                crossings += 1
    return crossings % 2 == 1


@pytest.fixture(scope="module")
def polygons(spark):
    features = [
        json.dumps({"type": "Feature", "properties": {"name": n, "rank": str(i)}, "geometry": g})
        for i, (n, g) in enumerate(SHAPES.items())
    ]
    df = spark.createDataFrame([(f,) for f in features], "feature string")
    return src.parse_features(df, "feature", {"name": "string", "rank": "int"})


@pytest.fixture(scope="module")
def lattice(spark):
    points = [(i, x / 2, y / 2) for i, (x, y) in enumerate(
        (x, y) for x in range(-22, 26) for y in range(-22, 26))]
    rng = random.Random(3)
    points += [(len(points) + i, rng.uniform(-11, 13), rng.uniform(-11, 13)) for i in range(300)]
    df = spark.createDataFrame(points, "id int, longitude double, latitude double").repartition(4)
    expected = sorted(
        (i, n) for i, x, y in points for n, g in SHAPES.items() if inside(g, x, y)
    )
    return df, expected


def test_columns_of_a_feature(polygons):
    row = polygons.where("name = 'parts'").first()
    assert row["rank"] == 2 and len(row["parts"]) == 2 and len(row["edges"]) == 4 + 3
    assert (row["xmin"], row["ymin"], row["xmax"], row["ymax"]) == (-10, -10, 12, 12)


@pytest.mark.parametrize("cell", [0.7, 1.0, 3.0, 50.0])
def test_match_equals_all_pairs_for_any_cell_size(lattice, polygons, rows, cell):
    points, expected = lattice
    assert rows(op.match_points(points, polygons, "name", cell=cell), "id", "name") == sorted(
        expected, key=lambda r: tuple((False, str(v)) for v in r)
    )


def test_shuffled_and_salted_join_gives_the_same(lattice, polygons, rows):
    points, expected = lattice
    crowded = points.unionByName(points.where("id = 10"))
    for i in range(3):
        crowded = crowded.unionByName(points.where("id = 10"))
    joined = op.match_points(crowded, polygons, "name", broadcast_bytes=0)
    wide = op.match_points(crowded, polygons, "name")
    assert rows(joined, "id", "name") == rows(wide, "id", "name")
    kept = op.keep_inside(points, polygons, "name", broadcast_bytes=0)
    assert kept.columns == points.columns
    assert {r[0] for r in rows(kept, "id")} == {i for i, _ in expected}
    assert kept.count() == len({i for i, _ in expected})


@pytest.mark.parametrize("cell", [0.37, 2.0])
def test_ragged_ring(spark, rows, cell):
    rng = random.Random(11)

    def ring(n, low, high):
        return [
            [r * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n)]
            for i in range(n)
            for r in [rng.uniform(low, high)]
        ]

    shape = {"type": "Polygon", "coordinates": [ring(400, 5, 9), ring(90, 1, 4)]}
    text = json.dumps({"properties": {"name": "ragged"}, "geometry": shape})
    polygon = src.parse_features(
        spark.createDataFrame([(text,)], "f string"), "f", {"name": "string"})
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(2000)]
    # the vertices themselves lie on the boundary
    points += [(2000 + i, x, y) for i, (x, y) in enumerate(shape["coordinates"][0][:200])]
    df = spark.createDataFrame(points, "id int, longitude double, latitude double")
    expected = {i for i, x, y in points if inside(shape, x, y)}
    kept = op.keep_inside(df, polygon, "name", cell=cell)
    assert {r[0] for r in kept.select("id").collect()} == expected
    tiles = op.tile_polygons(polygon, "name", cell)
    held = tiles.agg(F.sum(F.size("tile_edges"))).first()[0]
    boxes = sum(
        (int(max(a[0], b[0]) // cell) - int(min(a[0], b[0]) // cell) + 1)
        * (int(max(a[1], b[1]) // cell) - int(min(a[1], b[1]) // cell) + 1)
        for r in shape["coordinates"] for a, b in zip(r, r[1:] + r[:1])
    )
    assert 490 <= held <= boxes  # each edge is held by cells of its own box, by no others
    assert tiles.where("size(tile_turns) > 40").count() == 0


def test_tiles_grow_with_the_outline_not_the_area(spark):
    ring = [[-85, -40], [85, -40], [0, 40], [-85, -40]]
    text = json.dumps({"properties": {"name": "t"}, "geometry": {"type": "Polygon", "coordinates": [ring]}})
    area = src.parse_features(spark.createDataFrame([(text,)], "f string"), "f", {"name": "string"})
    counts = []
    for cell in (2.0, 1.0, 0.25):
        tiles = op.tile_polygons(area, "name", cell)
        counts.append(tiles.count())
        # the tiles cover the triangle once: inside tiles by their area, the rest along the outline
        inside = tiles.where("tile_inside").agg(F.sum(F.expr("power(4, tile_level)"))).first()[0]
        edged = tiles.where("NOT tile_inside").count()
        assert inside * cell**2 <= 170 * 80 / 2 <= (inside + edged) * cell**2
    assert counts[1] < 2.6 * counts[0] and counts[2] < 4.6 * counts[1]  # not 4 and 16 times
    assert counts[2] < 13_851


def test_only_crowded_cells_are_dealt_out(spark, rows):
    def points(cells):
        df = spark.createDataFrame(cells, "x long, y long")
        return df.select(F.struct(F.lit(0).alias("level"), "x", "y").alias("__cell"))

    def tiles(cells):
        return spark.createDataFrame(
            [(0, x, y) for x, y in cells], "tile_level int, tile_x long, tile_y long")

    single = [(0, 0)] + [(1, i) for i in range(50)]
    many = points([(0, 0)] * 500 + [(1, i % 50) for i in range(500)])
    crowded = _crowded_cells(many, tiles(single), True)
    assert rows(crowded) == [(0, 0, 0, 4, 1)]  # half of the tests are 4 shares of 8 tasks
    even = points([(i, i) for i in range(64)])
    assert _crowded_cells(even, tiles([(i, i) for i in range(64)]), True).count() == 0
    assert _crowded_cells(even.where("__cell.x < 0"), tiles(single), True).count() == 0
    # a cell crowded with tiles too: they are parted, but not where a point may match once only
    stacked = tiles(single + [(0, 0)] * 600)
    assert rows(_crowded_cells(many, stacked, True)) == [(0, 0, 0, 3, 3)]
    assert rows(_crowded_cells(many, stacked, False)) == [(0, 0, 0, 8, 1)]


def test_a_cell_crowded_on_both_sides_is_shared(spark):
    """Hundreds of polygons over one cell and thousands of points in it."""
    def square(i):
        w = (100 + i) / 1000
        ring = [[0, 0], [w, 0], [w, 0.9], [0, 0.9], [0, 0]]
        geometry = {"type": "Polygon", "coordinates": [ring]}
        return (json.dumps({"properties": {"name": str(i)}, "geometry": geometry}),)

    areas = src.parse_features(
        spark.createDataFrame([square(i) for i in range(600)], "f string"), "f", {"name": "string"})
    points = spark.range(3000, numPartitions=12).select(
        F.col("id"), (F.col("id") % 1000 / 1000).alias("longitude"), F.lit(0.5).alias("latitude"))
    joined = op.match_points(points, areas, "name", broadcast_bytes=0)
    option = "spark.sql.adaptive.enabled"
    spark.conf.set(option, "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(option)
    # a square of width w holds the points up to w: 3 * (1000 w + 1) of them
    assert sum(sizes) == sum(3 * (100 + i + 1) for i in range(600))
    assert len(sizes) >= 5 and max(sizes) < 0.6 * sum(sizes)
    kept = op.keep_inside(points, areas, "name", broadcast_bytes=0)
    assert kept.count() == 3 * 700
    assert op.keep_inside(points, areas, "name", cell=0.01).count() == 3 * 700


def test_copies_of_one_point_are_spread(spark, polygons):
    copies = spark.range(4000, numPartitions=40).select(
        F.lit(1.0).alias("longitude"), F.lit(1.0).alias("latitude")
    )
    joined = op.match_points(copies, polygons, "name", broadcast_bytes=0)
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(option)
    assert sum(sizes) == 8000 and len(sizes) > 2 and max(sizes) < 6000


def test_keep_inside_gives_each_point_once(lattice, polygons):
    points, expected = lattice
    kept = op.keep_inside(points, polygons, "name")
    assert kept.columns == points.columns
    assert kept.count() == len({i for i, _ in expected}) < len(expected)


def test_edges_vertices_and_holes(spark, polygons):
    cases = {(4.0, 4.0): True, (4.0, 4.5): False, (0.0, 3.0): True, (8.0, 8.0): True,
             (-2.0, -2.0): False, (-4.0, -2.0): True, (-5.0, -5.0): True, (60.0, 0.0): False}
    df = spark.createDataFrame(list(cases), "longitude double, latitude double")
    kept = {tuple(r) for r in op.keep_inside(df, polygons, "name").collect()}
    assert kept == {p for p, v in cases.items() if v}


def test_tolerance_reaches_into_the_next_cell(spark, polygons):
    df = spark.createDataFrame(
        [(8.004, 3.0), (8.02, 3.0), (3.0, -0.004)], "longitude double, latitude double"
    )
    kept = op.keep_inside(df, polygons.where("name = 'concave'"), "name", tolerance=0.01)
    assert {tuple(r) for r in kept.collect()} == {(8.004, 3.0), (3.0, -0.004)}


def test_count_in_polygons_keeps_empty_ones(lattice, polygons, rows):
    points, expected = lattice
    points = points.withColumn("best", F.when(F.col("id") % 3 != 0, F.col("id")))
    out = op.count_in_polygons(
        polygons, points, "name",
        {"n": op.measure_rows(), "p": op.measure_present("best"), "s": op.lenient_sum("best")},
    )
    by_name = {r["name"]: (r["n"], r["p"], r["s"]) for r in out.collect()}
    for name in SHAPES:
        ids = [i for i, n in expected if n == name]
        known = [i for i in ids if i % 3 != 0]
        assert by_name[name] == (len(ids), len(known), sum(known))
    assert by_name["empty"] == (0, 0, 0)


def test_spatial_left_join(lattice, polygons, rows):
    points, expected = lattice
    out = op.spatial_left_join(polygons, points, "name", carry=["name", "rank"])
    pairs = rows(out, "name", "id")
    assert [p for p in pairs if p[0] == "empty"] == [("empty", None)]
    assert len(pairs) == len(expected) + 1


def test_no_nested_loop_and_points_are_not_shuffled(lattice, polygons):
    points, _ = lattice
    joined = op.match_points(points, polygons, "name")
    plan = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("bad", ["fail", "drop"])
def test_the_box_of_the_polygons_reaches_the_reader(lattice, polygons, rows, tmp_path, bad):
    points, expected = lattice
    points.write.parquet(str(tmp_path / "points"))
    stored = points.sparkSession.read.parquet(str(tmp_path / "points"))
    joined = op.match_points(stored, polygons, "name", bad=bad)
    plan = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(longitude" in pushed and "LessThanOrEqual(latitude" in pushed
    # what could hide a bad point from the check must not reach the reader alone
    assert ("IsNotNull(longitude)" in pushed) == (bad == "drop")
    assert joined.count() == len(expected)


def test_points_that_are_not_numbers_match_nothing_if_dropped(spark, polygons):
    nan, inf = float("nan"), float("inf")
    odd = spark.createDataFrame(
        [(nan, 1.0), (1.0, nan), (inf, 1.0), (None, 1.0), (nan, nan)],
        "longitude double, latitude double",
    )
    for cell in (0.5, 1.0, 30.0):
        assert op.match_points(odd, polygons, "name", cell=cell, bad="drop").count() == 0
    nothing = polygons.where("name = 'none'")
    assert op.match_points(odd, nothing, "name", bad="drop").count() == 0
    with pytest.raises(ValueError, match="unknown mode"):
        op.match_points(odd, polygons, "name", bad="keep")


BAD = {"missing x": (None, 1.0), "missing y": (1.0, None), "far": (200.0, 1.0),
       "north": (1.0, -91.0), "no number": (float("nan"), 1.0), "infinite": (float("inf"), 1.0)}


def _points_with(spark, kind, path):
    """The bad point alone and beside a good one; stored, each in a file with its own statistics."""
    schema = "longitude double, latitude double"
    good, bad = (spark.createDataFrame([p], schema) for p in ((1.0, 1.0), BAD[kind]))
    if path is None:
        return [bad, good.union(bad)]
    for n, parts in enumerate(((bad,), (good, bad))):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(f"{path}/{n}")
    return [spark.read.parquet(f"{path}/{n}") for n in (0, 1)]


def _fails(job):
    with pytest.raises(PySparkException, match="bad coordinates"):
        job().collect()


def test_every_kind_of_bad_point_is_seen(spark, polygons, tmp_path):
    for kind in BAD:
        for points in _points_with(spark, kind, None):
            _fails(lambda: op.point_columns(points).where("longitude < 150 AND latitude IS NOT NULL"))
    shapes = op.settle(polygons.where("name = 'concave'"))
    for kind, path in (("far", tmp_path / "far"), ("missing y", tmp_path / "missing"), ("no number", None)):
        for points in _points_with(spark, kind, path):
            _fails(lambda: op.keep_inside(points, shapes, "name"))


@pytest.mark.parametrize("kind", ["missing x", "far"])
def test_a_bad_point_fails_every_spatial_job(spark, polygons, tmp_path, kind):
    """With and without polygons, broadcast or shuffled."""
    shapes = op.settle(polygons.where("name = 'concave'"))
    none, number = shapes.where("false"), {"n": op.measure_rows()}
    points = _points_with(spark, kind, tmp_path)[1]
    _fails(lambda: op.count_in_polygons(shapes, points, "name", number))
    _fails(lambda: op.keep_inside(points, none, "name"))
    _fails(lambda: op.count_in_polygons(none, points, "name", number))
    _fails(lambda: op.spatial_left_join(none, points, "name"))
    _fails(lambda: op.spatial_left_join(shapes, points, "name", broadcast_bytes=0))
    _fails(lambda: op.keep_inside(op.point_columns(points), shapes, "name"))


def test_bad_coordinates(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 2.0), (200.0, 3.0)], "longitude double, latitude double"
    )
    assert op.point_columns(df, bad="drop").count() == 1
    assert tuple(op.point_problems(df).first()) == (3, 1, 1)
    with pytest.raises(PySparkException, match="bad coordinates"):
        op.point_columns(df).collect()


def test_points_must_not_have_the_polygon_id(lattice, polygons):
    points, _ = lattice
    with pytest.raises(ValueError, match="name"):
        op.match_points(points.withColumn("name", F.lit("x")), polygons, "name")


def test_polygon_across_the_date_line_fails(spark):
    wide = json.dumps({"properties": {"name": "w"}, "geometry": {
        "type": "Polygon", "coordinates": [[[-179, 0], [179, 0], [179, 5], [-179, 0]]]}})
    polygon = src.parse_features(
        spark.createDataFrame([(wide,)], "f string"), "f", {"name": "string"})
    points = spark.createDataFrame([(0.0, 1.0)], "longitude double, latitude double")
    with pytest.raises(PySparkException, match="polygon too wide"):
        op.match_points(points, polygon, "name").collect()


def test_wkt(polygons):
    text = {r["name"]: r["w"] for r in polygons.withColumn(
        "w", src.polygon_wkt(F.col("parts"))).collect()}
    assert text["empty"] == "MULTIPOLYGON (((50.0 50.0, 51.0 50.0, 51.0 51.0, 50.0 50.0)))"
    assert text["hole"].count("(") == 4


def test_repeated_and_missing_ids_are_polygons_of_their_own(spark, rows):
    def square(name, x):
        ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
        geometry = {"type": "Polygon", "coordinates": [ring]}
        return (json.dumps({"properties": {"name": name, "x": x}, "geometry": geometry}),)

    df = spark.createDataFrame([square("a", 0), square("a", 0.5), square(None, 4)], "f string")
    areas = src.parse_features(df, "f", {"name": "string", "x": "double"})
    points = spark.createDataFrame(
        [(1, 0.2, 0.5), (2, 0.7, 0.5), (3, 4.5, 0.5)], "id int, longitude double, latitude double"
    )
    counted = op.count_in_polygons(areas, points, "name", {"n": op.measure_rows()})
    assert rows(counted, "x", "n") == [(0.0, 2), (0.5, 1), (4.0, 1)]
    joined = op.spatial_left_join(areas, points, "name", carry=["name", "x"])
    assert rows(joined, "x", "id") == [(0.0, 1), (0.0, 2), (0.5, 2), (4.0, 3)]


def test_a_long_outline_is_tiled_by_several_tasks(spark):
    n = 20_000
    ring = [[9 * math.cos(2 * math.pi * i / n), 9 * math.sin(2 * math.pi * i / n)]
            for i in range(n)]
    text = json.dumps({"properties": {"name": "round"},
                       "geometry": {"type": "Polygon", "coordinates": [ring]}})
    area = src.parse_features(
        spark.createDataFrame([(text,)], "f string"), "f", {"name": "string"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tiles = op.tile_polygons(area, "name", 0.5).withColumn("task", F.spark_partition_id())
        got = tiles.agg(F.count_distinct("task"), F.sum(F.size("tile_edges"))).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0] > 1 and got[1] >= n
