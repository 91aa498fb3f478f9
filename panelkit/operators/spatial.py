"""Points in polygons by an equi-join on cells of a quadtree, and an exact test.

A polygon is a row with an ``edges`` column (see ``sources.geojson``): an array of segments
over all rings of all parts. It is covered by tiles: small ones along its outline, larger and
larger ones inside. A point has one cell of each size, and of a polygon's tiles at most one holds
it, so joining on size and cell neither loses nor repeats a match, whatever the sizes.

The test counts the edges to the right of the point. A tile holds only the edges that enter its
cell. Of those further right just the count matters, and that is the same for the whole cell but
for the heights at which their chain ends: a number and a few heights stand for them all. A cell
that no edge enters is inside or outside as a whole: its points need no test, outside cells are
left out, and inside cells are merged four by four as far as they go. So the tiles of a polygon
are about as many as its outline is long, however large its area.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import n_rows
from .aggregate import Measures, summarise
from .staging import BROADCAST_BYTES, fits_in_broadcast, settle

EDGE_BYTES, TILE_BYTES = 56, 96
ROW = "__polygon"
STEP = 2
"""Cells of the next level are 2**STEP times as wide; each point looks up one cell per level."""
TILES_AT_ONCE = 256
"""Tiles of one crowded cell that a task tests its points against."""


def _wrong(x: Column, y: Column) -> Column:
    """Is a coordinate missing, out of range or no number? Never NULL, and a reader can prune by it.

    NaN counts as larger than any number, so the upper bounds catch it.
    """
    return x.isNull() | y.isNull() | (x < -180) | (x > 180) | (y < -90) | (y > 90)


def _unless_wrong(x: Column, y: Column, value: Column) -> Column:
    """``value``, or an error where the coordinates are wrong.

    Both stand in one CASE, so no filter that is inferred from ``value`` can remove a wrong row
    before it is seen.
    """
    shown = F.to_json(F.struct(x.alias("x"), y.alias("y")))
    message = F.concat(F.lit("bad coordinates: "), shown)
    return F.when(_wrong(x, y), F.raise_error(message)).otherwise(value)


def _bad_rows(bad: str) -> bool:
    if bad not in ("fail", "drop"):
        raise ValueError(f"unknown mode {bad!r}")
    return bad == "fail"


def point_columns(
    df: DataFrame, x: str = "longitude", y: str = "latitude", bad: str = "fail"
) -> DataFrame:
    """Check coordinates: a missing or out-of-range one fails the query, or drops the row.

    Rows that another column's filter removes may go before they are checked; a filter on the
    coordinates themselves cannot remove a bad one. The operators below check the points they
    are given in the same way, and then still prune by the extent of the polygons.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    if not _bad_rows(bad):
        return df.where(~_wrong(px, py)).withColumns({x: px, y: py})
    checked = {x: _unless_wrong(px, py, px), y: _unless_wrong(px, py, py)}
    return df.where(_unless_wrong(px, py, F.lit(True))).withColumns(checked)


def point_problems(df: DataFrame, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """One row with the number of points, of missing and of out-of-range coordinates."""
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    missing = px.isNull() | py.isNull()
    outside = ~(px.between(-180, 180) & py.between(-90, 90))
    return df.agg(
        n_rows().alias("points"),
        F.count(F.when(missing, True)).alias("missing"),
        F.count(F.when(~missing & outside, True)).alias("out_of_range"),
    )


def covered_by(
    edges: Column, x: Column, y: Column, tolerance: float = 0.0, already: Column | None = None
) -> Column:
    """Is the point inside or on the boundary? Even-odd over all edges, so holes just work.

    ``already`` is the number of crossings known beforehand, by default 0. The sign of the cross
    product tells on which side of an edge the point lies; 0 within the edge's box is on the
    edge. There is no division. With a tolerance, a point that close to an edge counts as on it.
    """

    def step(state: Column, e: Column) -> Column:
        side = (e.x2 - e.x1) * (y - e.y1) - (x - e.x1) * (e.y2 - e.y1)
        if tolerance:
            t = F.lit(float(tolerance))
            near_line = side * side <= t * t * (
                (e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)
            )
        else:
            t = F.lit(0.0)
            near_line = side == 0
        in_box = x.between(F.least(e.x1, e.x2) - t, F.greatest(e.x1, e.x2) + t) & y.between(
            F.least(e.y1, e.y2) - t, F.greatest(e.y1, e.y2) + t
        )
        crosses = ((e.y1 > y) != (e.y2 > y)) & ((side > 0) == (e.y2 > e.y1))
        # -1 once the boundary was hit, else the number of crossings so far
        return (
            F.when((state < 0) | (near_line & in_box), F.lit(-1))
            .when(crosses, state + 1)
            .otherwise(state)
        )

    state = F.aggregate(edges, F.lit(0) if already is None else already, step)
    return (state < 0) | (state % 2 == 1)


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size)))


def _numbered(polygons: DataFrame) -> DataFrame:
    """The polygons, written once, each with a number of its own: ids may repeat or be NULL."""
    return settle(polygons.withColumn(ROW, F.monotonically_increasing_id()))


def _odd_runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, tile_x): the cells with an odd number of ``__left`` values further right.

    Outlines are closed, so the values that occur an odd number of times come in pairs, and the
    cells wanted lie from the first to just before the second of a pair.
    """
    odd = rows.groupBy(*keys, "__left").agg(n_rows().alias("__n")).where("__n % 2 = 1")
    line = Window.partitionBy(*keys).orderBy("__left")
    runs = odd.withColumns(
        {"__nth": F.row_number().over(line), "__next": F.lead("__left").over(line)}
    ).where("__nth % 2 = 1 AND __next IS NOT NULL")
    return runs.select(*keys, F.explode(F.sequence("__left", F.col("__next") - 1)).alias("tile_x"))


def _row_spans(
    polygons: DataFrame, key: Sequence[str], edges: str, cell: float, tolerance: float
) -> DataFrame:
    """(*key, __edge, tile_y, __left, __right, ...): the cells that an edge may touch, row by row.

    The part of an edge within a row is cut out a little too large, by more than rounding can
    amount to, so no cell is missed; a point to the left of the span has all of the edge's part
    in that row on its right.
    """
    t = F.lit(float(tolerance))
    e = F.col("__edge")
    low_x, high_x = F.least(e.x1, e.x2), F.greatest(e.x1, e.x2)
    low_y, high_y = F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)
    spans = (
        polygons.select(*key, F.explode(edges).alias("__edge"))
        .withColumns(
            {
                "__first": _cell(low_y, cell),  # rows of the ends, without the tolerance
                "__last": _cell(high_y, cell),
                "tile_y": F.explode(F.sequence(_cell(low_y - t, cell), _cell(high_y + t, cell))),
            }
        )
    )
    more = t + (F.abs("tile_y") + 1) * F.lit(cell * 1e-12)
    bottom, top = F.col("tile_y") * F.lit(float(cell)) - more, (F.col("tile_y") + 1) * F.lit(float(cell)) + more
    rise = F.when(e.y1 != e.y2, e.y2 - e.y1)  # NULL for a level edge

    def at(height: Column, end: Column) -> Column:
        within = F.least(F.greatest(height, low_y), high_y)
        return F.coalesce(e.x1 + (e.x2 - e.x1) * ((within - e.y1) / rise), end)

    one, two = at(bottom, e.x1), at(top, e.x2)
    slack = t + (F.abs(e.x1) + F.abs(e.x2)) * F.lit(1e-13)
    left = F.greatest(_cell(F.least(one, two) - slack, cell), _cell(low_x - t, cell))
    right = F.least(_cell(F.greatest(one, two) + slack, cell), _cell(high_x + t, cell))
    return spans.withColumns({"__left": left, "__right": right})


def tile_polygons(
    polygons: DataFrame,
    id_col: str,
    cell: float = 1.0,
    edges: str = "edges",
    tolerance: float = 0.0,
    max_width: float = 180.0,
) -> DataFrame:
    """The cover of each polygon: one row per tile.

    (id, tile_level, tile_x, tile_y, tile_edges, tile_turns, tile_base, tile_inside): a tile of
    level k is 2**k cells wide. It is inside as a whole, or it is a single cell and has the edges
    that enter it, whether an odd number of edges further right passes below its row (0 or 1),
    and the heights within the row at which such an edge starts or ends.

    Edges, not polygons, are the unit of work. Each goes to the cells that it may touch in each
    row. Where two edges meet, their heights cancel out but in the cells between their left ends.
    Cells with an edge make up the outline on each level; the inside tiles are those of their
    neighbours in the same larger cell that have no edge and an odd number further right. So the
    work grows with the outline, and a long outline is shared by many tasks. Rows with the same
    id, or none, are polygons of their own. A polygon wider than ``max_width`` most likely
    crosses the date line, where planar tests are wrong, and fails the query.
    """
    if id_col != ROW:
        polygons = _numbered(polygons.select(id_col, edges))
    ends = F.flatten(F.transform(edges, lambda e: F.array(e.x1, e.x2)))
    width = F.array_max(ends) - F.array_min(ends)
    message = F.concat(F.lit("polygon too wide: "), F.col(id_col).cast("string"))
    narrow = F.when(width > max_width, F.raise_error(message).cast("boolean")).otherwise(True)
    key = list(dict.fromkeys([ROW, id_col]))
    e = F.col("__edge")
    spans = settle(_row_spans(polygons.where(narrow), key, edges, cell, tolerance))
    place = [*key, "tile_x", "tile_y"]
    entering = spans.select(
        *key, "__edge", "tile_y", F.explode(F.sequence("__left", "__right")).alias("tile_x")
    )
    heights = F.filter(F.array(e.y1, e.y2), lambda y: _cell(y, cell) == F.col("tile_y"))
    ends = spans.select(*key, "tile_y", "__left", F.explode(heights).alias("__height"))
    turns = _odd_runs(ends, [*key, "tile_y", "__height"])
    passing = spans.where("__first < tile_y AND tile_y <= __last").select(*key, "tile_y", "__left")
    across = F.greatest(
        F.max("__right") - F.min("__left"), F.max("tile_y") - F.min("tile_y")
    )
    widest = spans.groupBy(ROW).agg(across.alias("n")).agg(F.max("n")).first()[0] or 0
    cells = entering.select(*place).distinct()
    asked = cells.select(*place, F.lit(0).alias("tile_level")).unionByName(
        _inner_candidates(cells, key, int(widest)), allowMissingColumns=True
    )
    judged = _with_base(asked, passing, key)
    whole = judged.where("__edged = 0 AND tile_base = 1")
    outline = judged.where("__edged = 1")
    held = (
        entering.select(*place, "__edge")
        .unionByName(turns.select(*place, "__height"), allowMissingColumns=True)
        .unionByName(outline.select(*place, "tile_base"), allowMissingColumns=True)
        .groupBy(*place)
        .agg(
            F.collect_list("__edge").alias("tile_edges"),
            F.collect_list("__height").alias("tile_turns"),
            F.coalesce(F.max("tile_base"), F.lit(0)).alias("tile_base"),
        )
        .withColumns({"tile_level": F.lit(0), "tile_inside": F.lit(False)})
    )
    names = ["tile_level", "tile_x", "tile_y", "tile_edges", "tile_turns", "tile_base", "tile_inside"]
    none = whole.withColumns(
        {
            "tile_edges": F.array().cast(held.schema["tile_edges"].dataType),
            "tile_turns": F.array().cast("array<double>"),
            "tile_inside": F.lit(True),
        }
    )
    return held.select(id_col, *names).unionByName(none.select(id_col, *names))


def _inner_candidates(cells: DataFrame, key: Sequence[str], widest: int) -> DataFrame:
    """Tiles without an edge that have a sister with one, on all levels: inside or outside.

    ``cells`` are those with edges, and no two of a polygon are further apart than ``widest``. On
    the highest level a polygon then covers two cells each way at most, so none of them lies
    inside, and every inside cell has one such tile that holds it.
    """
    highest = -(-widest.bit_length() // STEP) * STEP
    levels = F.explode(F.sequence(F.lit(0), F.lit(highest), F.lit(STEP))).alias("tile_level")
    edged = cells.select(*key, "tile_x", "tile_y", levels)
    up = {c: F.expr(f"shiftright({c}, tile_level)") for c in ("tile_x", "tile_y")}
    edged = edged.withColumns(up).distinct()
    sisters = F.sequence(F.lit(0), F.lit(2**STEP - 1))
    below = (
        edged.where(F.col("tile_level") > 0)
        .withColumn("tile_level", F.col("tile_level") - STEP)
        .withColumn("__dx", F.explode(sisters))
        .withColumn("__dy", F.explode(sisters))
        .withColumns({c: F.col(c) * 2**STEP + F.col(d) for c, d in (("tile_x", "__dx"), ("tile_y", "__dy"))})
        .drop("__dx", "__dy")
    )
    on = [ROW, "tile_level", "tile_x", "tile_y"]
    return below.join(edged.select(*on), on, "left_anti").select(
        *key, "tile_x", "tile_y", "tile_level"
    ).withColumn("__inner", F.lit(1))


def _with_base(asked: DataFrame, passing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``tile_base``: is the number of passing edges further right odd? And ``__edged``.

    Asked is the lowest left cell of a tile; in a tile without edges it speaks for all cells.
    """
    corner = {f"__{c}": F.expr(f"shiftleft({c}, tile_level)") for c in ("tile_x", "tile_y")}
    asked = asked.withColumns(corner).withColumn("__mark", F.lit(0))
    odd = passing.groupBy(*key, F.col("tile_y").alias("__tile_y"), F.col("__left").alias("__tile_x")).agg(
        (n_rows() % 2).cast("int").alias("__mark")
    )
    rows = asked.unionByName(odd.where("__mark = 1"), allowMissingColumns=True)
    # from right to left; an edge that begins in the asked cell itself is not further right
    line = Window.partitionBy(ROW, "__tile_y").orderBy(F.col("__tile_x").desc(), "__mark")
    passed = F.sum("__mark").over(line.rowsBetween(Window.unboundedPreceding, 0))
    edged = F.when(F.col("__inner").isNull(), 1).otherwise(0)
    return (
        rows.withColumns({"tile_base": (passed % 2).cast("int"), "__edged": edged})
        .where("__mark = 0")
        .drop("__tile_x", "__tile_y", "__mark", "__inner")
    )


def _outermost(tiles: DataFrame, highest: int) -> DataFrame:
    """The tiles without those that lie within an inside tile of whatever polygon.

    Of the cells that hold a point, one at most then has tiles that can match it.
    """
    same = ["tile_level", "tile_x", "tile_y"]
    inside = tiles.where("tile_inside").select(*same).distinct()
    above = F.explode(F.sequence(F.col("tile_level"), F.lit(highest), F.lit(STEP))).alias("__level")
    over = tiles.select(*same).distinct().select("*", above)
    up = [F.expr(f"shiftright({c}, __level - tile_level)").alias(f"__{c}") for c in same[1:]]
    over = over.select("*", *up)
    covered = over.join(
        inside.select(*[F.col(c).alias(f"__in_{c}") for c in same]),
        (F.col("__level") == F.col("__in_tile_level"))
        & (F.col("__tile_x") == F.col("__in_tile_x"))
        & (F.col("__tile_y") == F.col("__in_tile_y")),
    )
    # an inside tile is covered by itself, which does not count
    deeper = covered.where("__level > tile_level").select(*same).distinct()
    left = tiles.join(deeper, same, "left_anti")
    # beside an inside tile of one cell the edges of others need no test
    whole = left.where("tile_inside").dropDuplicates(same)
    return left.where("NOT tile_inside").join(inside, same, "left_anti").unionByName(whole)


def _crowded_cells(points: DataFrame, tiles: DataFrame, split_tiles: bool) -> DataFrame:
    """(level, x, y, __shares, __parts) of the cells with more than one task's share of tests.

    A cell has as many tests as points times tiles. Its tiles are parted where they are many,
    and its points dealt out, so that points' shares times tiles' parts are its share of all
    tasks. The shares of all cells add up to the number of tasks, so the table has fewer rows
    than there are tasks, however points and polygons lie.
    """
    spark = points.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["level", "x", "y"]
    there = points.groupBy(*[F.col(f"__cell.{c}").alias(c) for c in names]).agg(
        F.count(F.lit(1)).alias("points")
    )
    held = tiles.groupBy(*[F.col(f"tile_{c}").alias(c) for c in names]).agg(
        F.count(F.lit(1)).alias("tiles")
    )
    cells = settle(there.join(held, names))
    tests = F.col("points") * F.col("tiles")
    total = cells.agg(F.sum(tests)).first()[0] or 0
    pieces = F.ceil(tests * F.lit(float(tasks)) / F.lit(float(max(total, 1))))
    parts = F.least(pieces, F.ceil(F.col("tiles") / TILES_AT_ONCE)) if split_tiles else F.lit(1)
    return (
        cells.withColumn("__parts", parts.cast("int"))
        .withColumn("__shares", F.ceil(pieces / F.col("__parts")).cast("int"))
        .where("__shares * __parts > 1")
        .select(*[F.col(c).alias(f"__crowd_{c}") for c in names], "__shares", "__parts")
    )


def _join_tiles(
    points: DataFrame,
    tiles: DataFrame,
    x: str,
    y: str,
    cell: float,
    how: str,
    tolerance: float,
    broadcast_bytes: int,
    bad: str,
) -> DataFrame:
    """Join points to the tiles of their cells, then test exactly.

    The tiles are written once, then their size and extent are measured. Small tiles are
    broadcast: the points are then not shuffled at all, and a crowded cell is no problem. Beyond
    that size both sides are shuffled on the cell and its piece: the points of a crowded cell
    are dealt out, and where its tiles are many these are parted as well, so that a task has
    its share of the tests; all other cells stay whole.
    """
    names = points.columns
    tiles = settle(tiles)
    tile_bytes = F.size("tile_edges") * EDGE_BYTES + F.size("tile_turns") * 8 + TILE_BYTES
    low = {c: F.expr(f"shiftleft(tile_{c}, tile_level)") for c in ("x", "y")}
    high = {c: F.expr(f"shiftleft(tile_{c} + 1, tile_level) - 1") for c in ("x", "y")}
    measured = tiles.agg(
        F.sum(tile_bytes.cast("bigint")).alias("size"),
        F.collect_set("tile_level").alias("levels"),
        F.min(low["x"]).alias("west"),
        F.max(high["x"]).alias("east"),
        F.min(low["y"]).alias("south"),
        F.max(high["y"]).alias("north"),
    ).first()
    if how == "left_semi" and len(measured["levels"]) > 1:  # a point has one row per level
        tiles = _outermost(tiles, max(measured["levels"]))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    # the box of all tiles, a cell wider on each side; on a stored column it reaches the reader
    near = F.lit(False)
    if measured["size"] is not None:
        near = px.between((measured["west"] - 1) * cell, (measured["east"] + 2) * cell) & py.between(
            (measured["south"] - 1) * cell, (measured["north"] + 2) * cell
        )
    at = {"__at_x": _cell(px, cell), "__at_y": _cell(py, cell)}
    if _bad_rows(bad):
        # the reader may skip what is neither near nor wrong; what it reads is judged at once
        points = points.where(near | _wrong(px, py)).where(_unless_wrong(px, py, near))
        if measured["size"] is None:
            points.isEmpty()  # a join with nothing might never look at the points
        at = {name: _unless_wrong(px, py, value) for name, value in at.items()}
    else:
        points = points.where(~_wrong(px, py) & near)
    cells = [
        F.struct(
            F.lit(level).alias("level"),
            F.expr(f"shiftright(__at_x, {level})").alias("x"),
            F.expr(f"shiftright(__at_y, {level})").alias("y"),
        )
        for level in sorted(measured["levels"]) or [0]
    ]
    own = F.explode(F.array(*cells)) if len(cells) > 1 else cells[0]
    points = points.withColumns(at).withColumn("__cell", own).drop("__at_x", "__at_y")
    on = F.lit(True)
    for c in ("level", "x", "y"):
        on = on & (F.col(f"__cell.{c}") == F.col(f"tile_{c}"))
    already = F.col("tile_base") + F.size(F.filter("tile_turns", lambda height: height <= py))
    exact = F.col("tile_inside") | covered_by(F.col("tile_edges"), px, py, tolerance, already)
    if (measured["size"] or 0) <= broadcast_bytes:
        tiles = F.broadcast(tiles)
    else:
        crowded = F.broadcast(_crowded_cells(points, tiles, how == "inner"))

        def crowd(kind: str) -> Column:
            same = F.lit(True)
            for c in ("level", "x", "y"):
                same = same & (F.col(f"{kind}{c}") == F.col(f"__crowd_{c}"))
            return same

        shares, parts = (F.coalesce(c, F.lit(1)) for c in ("__shares", "__parts"))
        # the partition number parts even identical rows, and is the same when a task is rerun
        hashable = [name for name, kind in points.dtypes if "map<" not in kind]
        spread = F.xxhash64(*hashable, F.spark_partition_id())
        points = (
            points.withColumn("__spread", spread)
            .join(crowded, crowd("__cell."), "left")
            .withColumn("__share", F.pmod(F.col("__spread"), shares).cast("int"))
            .withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select(*names, "__cell", "__share", "__part")
        )
        spread = F.xxhash64(*[c for c in tiles.columns], F.spark_partition_id())
        tiles = (
            tiles.withColumn("__spread", spread)
            .join(crowded, crowd("tile_"), "left")
            .withColumn("tile_part", F.pmod(F.col("__spread"), parts).cast("int"))
            .withColumn("tile_share", F.explode(F.sequence(F.lit(0), shares - 1)))
            .drop("__crowd_level", "__crowd_x", "__crowd_y", "__shares", "__parts", "__spread")
            .hint("shuffle_hash")
        )
        on = on & (F.col("__share") == F.col("tile_share")) & (F.col("__part") == F.col("tile_part"))
    return points.join(tiles, on & exact, how).drop(
        "__cell", "__share", "__part",
        "tile_level", "tile_x", "tile_y", "tile_share", "tile_part",
        "tile_inside", "tile_edges", "tile_base", "tile_turns",
    )


def match_points(
    points: DataFrame,
    polygons: DataFrame,
    id_col: str,
    x: str = "longitude",
    y: str = "latitude",
    cell: float = 1.0,
    tolerance: float = 0.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    bad: str = "fail",
) -> DataFrame:
    """Each point with the id of each polygon that covers it; points outside all are left out.

    ``cell`` is the grid size in the unit of the coordinates. It changes the speed, not the
    answer: small cells leave more points without a test and make more tiles. A missing or
    out-of-range coordinate fails the query, wherever the polygons lie and even if there are
    none; with ``bad="drop"`` such a point matches nothing.
    """
    _no_clash(points, [id_col])
    tiles = tile_polygons(polygons, id_col, cell, tolerance=tolerance)
    return _join_tiles(
        points, tiles, x, y, cell, "inner", tolerance, broadcast_bytes, bad
    )


def keep_inside(
    points: DataFrame,
    polygons: DataFrame,
    id_col: str,
    x: str = "longitude",
    y: str = "latitude",
    cell: float = 1.0,
    tolerance: float = 0.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    bad: str = "fail",
) -> DataFrame:
    """The points that lie in any of the polygons, each once. ``bad`` as in ``match_points``."""
    tiles = tile_polygons(polygons, id_col, cell, tolerance=tolerance)
    return _join_tiles(
        points, tiles, x, y, cell, "left_semi", tolerance, broadcast_bytes, bad
    )


def count_in_polygons(
    polygons: DataFrame,
    points: DataFrame,
    id_col: str,
    measures: Measures,
    x: str = "longitude",
    y: str = "latitude",
    cell: float = 1.0,
    **options,
) -> DataFrame:
    """Every polygon with measures over the points it covers; 0 where it covers none.

    The points are matched and combined per polygon before anything is shuffled; only then the
    polygons are joined back, one row each. Rows with the same id, or none, count on their own.
    """
    _no_clash(points, [id_col])
    numbered = _numbered(polygons)
    matched = match_points(points, numbered, ROW, x, y, cell, **options)
    totals = summarise(matched, [ROW], measures).withColumnRenamed(ROW, "__id")
    zero_if_empty = {
        name: F.when(F.col("__id").isNull() & (F.lit(m.kind) != "strict"), F.lit(0))
        .otherwise(F.col(name))
        .alias(name)
        for name, m in measures.items()
    }
    return numbered.join(totals, F.col(ROW) == F.col("__id"), "left").select(
        *[numbered[c] for c in polygons.columns], *zero_if_empty.values()
    )


def spatial_left_join(
    polygons: DataFrame,
    points: DataFrame,
    id_col: str,
    x: str = "longitude",
    y: str = "latitude",
    cell: float = 1.0,
    carry: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Polygons with the points they cover, one row per pair; uncovered polygons have one row.

    ``carry`` names the polygon columns to keep (all by default). Matched points get the
    columns of their polygon, and the polygons without a match are added by a union: so no
    shuffle gathers the points of one polygon. The pairs are written once, so the points are
    read and tested once. Rows with the same id, or none, are polygons of their own.
    """
    carry = list(carry or polygons.columns)
    _no_clash(points, [id_col, *carry])
    numbered = _numbered(polygons)
    matched = settle(match_points(points, numbered, ROW, x, y, cell, **options))
    sides = numbered.select(F.col(ROW).alias("__id"), *carry)
    hit = matched.select(F.col(ROW).alias("__hit")).distinct()
    alone = sides.join(hit, sides["__id"] == hit["__hit"], "left_anti").select(*carry)
    if fits_in_broadcast(sides, F.length(F.to_json(F.struct(*sides.columns))) + 64):
        sides = F.broadcast(sides)
    pairs = matched.join(sides, matched[ROW] == sides["__id"])
    return pairs.select(*carry, *points.columns).unionByName(alone, allowMissingColumns=True)


def _no_clash(points: DataFrame, names: Sequence[str]) -> None:
    shared = sorted(set(names) & set(points.columns))
    if shared:
        raise ValueError(f"points have columns {shared} too; rename one side")
