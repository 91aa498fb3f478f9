"""GeoJSON polygons as arrays, and their text form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import fits_in_broadcast, settle
from .lines import BLOCK, blocks_before, file_lines, rows_before, rows_so_far, with_blocks

FEATURE = (
    "struct<type: string, id: string, properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>"
)
POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"


def read_geojson(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: Mapping[str, str],
    lines: bool = False,
) -> DataFrame:
    """Polygons of GeoJSON files: the named properties, then the columns of the geometry.

    ``properties`` maps a property to its type. With ``lines`` each line is one feature.
    Otherwise a file is a feature collection, however it is laid out, and is read by as many
    tasks as its size asks for.
    """
    text = spark.read.text(paths) if lines else split_features(spark, paths)
    features = text.select(F.from_json("value", FEATURE).alias("feature"))
    kind = F.col("feature.type")
    return _columns(features.where(kind.isNull() | (kind == "Feature")), properties)


def split_features(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(value): the text of each object that stands in a list of a collection, such as a feature.

    The files are read in pieces that end at closing braces. Whether a piece begins inside a
    string, how many braces and brackets are open there, and which feature it belongs to
    follows from the pieces before it. Each block of a file sums up its own for both cases
    (beginning in a string or not), and the sums of the blocks before tell which case holds.
    Features that go on in the next block are put together at the end.
    """
    pieces = file_lines(spark, paths, "}").select(*BLOCK, "row", "value")
    # an escaped character becomes two plain ones, so places stay as they are
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", "__"), '"', -1)

    def outside(begins_inside: int) -> Column:
        return F.array_join(F.filter("__parts", lambda _, i: (i + begins_inside) % 2 == 0), "")

    def deeper(begins_inside: int) -> Column:
        closed = (F.col("__flips") + begins_inside) % 2 == 0  # the brace after the piece counts
        return _count(outside(begins_inside), "{") - F.when(closed, 1).otherwise(0)

    def brackets(begins_inside: int) -> Column:
        text = outside(begins_inside)
        return _count(text, "[") - _count(text, "]")

    pieces = pieces.withColumn("__parts", parts)
    pieces = pieces.withColumn("__flips", (F.size("__parts") - 1) % 2)
    pieces = pieces.withColumns(
        {f"__{f.__name__}_{case}": f(case) for f in (deeper, brackets) for case in (0, 1)}
    )
    flipped = F.coalesce(F.sum("__flips").over(rows_before()), F.lit(0)) % 2
    pieces = pieces.withColumn("__flipped", flipped)
    # by whether the block, not the piece, begins inside a string
    both = {
        f"__{name}_block_{case}": F.when(F.col("__flipped") == 0, F.col(f"__{name}_{case}"))
        .otherwise(F.col(f"__{name}_{1 - case}"))
        for name in ("deeper", "brackets") for case in (0, 1)
    }
    pieces = pieces.withColumns(both).drop("__parts")
    sums = [F.sum(name).alias(name) for name in ("__flips", *both)]
    blocks = pieces.groupBy(*BLOCK).agg(*sums)
    blocks = blocks.withColumn(
        "__inside", F.coalesce(F.sum("__flips").over(blocks_before()), F.lit(0)) % 2
    )

    def chosen(name: str) -> Column:
        case = F.col("__inside") == 0
        return F.when(case, F.col(f"__{name}_block_0")).otherwise(F.col(f"__{name}_block_1"))

    starts = {
        f"__{name}_start": F.coalesce(F.sum(chosen(name)).over(blocks_before()), F.lit(0))
        for name in ("deeper", "brackets")
    }
    pieces = with_blocks(pieces, blocks.select(*BLOCK, "__inside", *[c.alias(n) for n, c in starts.items()]))
    open_before = {
        f"__{name}_open": F.col(f"__{name}_start")
        + F.coalesce(F.sum(chosen(name)).over(rows_before()), F.lit(0))
        for name in ("deeper", "brackets")
    }
    inside = (F.col("__inside") + F.col("__flipped")) % 2
    pieces = pieces.withColumns(open_before).withColumn("__plain", _blanked(parts, inside))
    depth, plain = F.col("__deeper_open"), F.col("__plain")
    # the brace that opens the second level: the first one of the piece, or the one after it
    first = F.instr(plain, "{")
    second = F.expr("locate('{', __plain, instr(__plain, '{') + 1)")
    at = F.when(depth == 1, first).when((depth == 0) & (first > 0), second)
    ahead = F.substring(plain, F.lit(1), F.col("__at"))
    listed = F.col("__brackets_open") + _count(ahead, "[") - _count(ahead, "]") > 0
    pieces = pieces.withColumn("__at", at)
    here = F.col("__at") > 0
    text = F.when(here, F.expr("substring(value, __at)")).when(depth >= 2, F.col("value"))
    pieces = pieces.select(
        *BLOCK,
        "row",
        F.last(F.when(here, F.col("row")), ignorenulls=True).over(rows_so_far()).alias("begun"),
        F.last(F.when(here, listed), ignorenulls=True).over(rows_so_far()).alias("listed"),
        text.alias("text"),
    ).where("text IS NOT NULL")
    ordered = F.array_sort(F.collect_list(F.struct("row", "text")))
    joined = F.concat(F.array_join(F.transform(ordered, lambda p: p["text"]), "}"), F.lit("}"))
    objects = pieces.groupBy(*BLOCK, "begun").agg(
        joined.alias("value"), F.bool_or("listed").alias("listed")
    )
    return _with_rest(settle(objects))


def _with_rest(objects: DataFrame) -> DataFrame:
    """The listed objects, whole: what a block begins with goes to the last one begun before it.

    There is at most one such piece per block.
    """
    last = F.when(
        F.max("begun").isNotNull(), F.struct(F.col("block"), F.max("begun").alias("begun"))
    )
    owners = objects.groupBy(*BLOCK).agg(last.alias("last"))
    owners = owners.select(*BLOCK, F.max("last").over(blocks_before()).alias("owner"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "value")))
    rest = (
        objects.where("begun IS NULL")
        .join(owners, BLOCK)
        .groupBy("path", F.col("owner.block").alias("block"), F.col("owner.begun").alias("begun"))
        .agg(F.array_join(F.transform(ordered, lambda p: p["value"]), "").alias("rest"))
    )
    rest = settle(rest)
    if fits_in_broadcast(rest, F.length("rest") + 64):
        rest = F.broadcast(rest)
    whole = objects.where("listed").join(rest, [*BLOCK, "begun"], "left")
    return whole.select(F.concat("value", F.coalesce("rest", F.lit(""))).alias("value"))


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _blanked(parts: Column, begins_inside: Column) -> Column:
    """The text with everything inside strings as blanks, so that places stay as they are."""
    blank = F.transform(
        parts,
        lambda part, i: F.when((i + begins_inside) % 2 == 0, part).otherwise(
            F.repeat(F.lit(" "), F.length(part))
        ),
    )
    return F.array_join(blank, '"')


def parse_features(df: DataFrame, text: str, properties: Mapping[str, str]) -> DataFrame:
    """The same from a column that holds one GeoJSON feature per row."""
    return _columns(df.select(F.from_json(text, FEATURE).alias("feature")), properties)


def _columns(features: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    picked = [
        F.col("feature.properties")[name].try_cast(kind).alias(name)
        for name, kind in properties.items()
    ]
    rows = features.select(
        *picked,
        F.col("feature.geometry.type").alias("__type"),
        F.col("feature.geometry.coordinates").alias("__text"),
    )
    return polygon_columns(rows, "__type", "__text").drop("__type", "__text")


def polygon_columns(df: DataFrame, kind: str, coordinates: str) -> DataFrame:
    """Add ``parts``, ``edges`` and the box columns from a geometry type and coordinate text.

    ``parts`` holds polygons of rings of (x, y); a single polygon is one part. ``edges`` holds
    the segments of all rings. Geometries of other types have neither.
    """
    nested = (
        F.when(F.col(kind) == "Polygon", F.array(F.from_json(coordinates, POLYGON)))
        .when(F.col(kind) == "MultiPolygon", F.from_json(coordinates, MULTIPOLYGON))
    )
    parts = F.transform(
        nested,
        lambda part: F.transform(
            part,
            lambda ring: F.transform(
                ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
            ),
        ),
    )
    df = df.withColumn("parts", parts)
    df = df.withColumn("edges", ring_edges(F.flatten("parts")))
    xs = F.transform("edges", lambda e: e.x1)
    ys = F.transform("edges", lambda e: e.y1)
    return df.withColumns(
        {
            "xmin": F.array_min(xs),
            "ymin": F.array_min(ys),
            "xmax": F.array_max(xs),
            "ymax": F.array_max(ys),
        }
    )


def ring_edges(rings: Column) -> Column:
    """Segments of all rings, each ring closed; zero-length segments are left out."""

    def edges_of(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))),
                             F.slice(ring, 1, 1))
        return F.filter(
            F.zip_with(
                ring,
                following,
                lambda a, b: F.struct(
                    a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")
                ),
            ),
            lambda e: (e.x1 != e.x2) | (e.y1 != e.y2),
        )

    return F.flatten(F.transform(rings, edges_of))


def polygon_wkt(parts: Column) -> Column:
    """MULTIPOLYGON text of a ``parts`` column."""

    def joined(items: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(items, ", "), F.lit(")"))

    rings = F.transform(
        parts,
        lambda part: joined(
            F.transform(
                part,
                lambda ring: joined(
                    F.transform(
                        ring,
                        lambda p: F.concat_ws(" ", p.x.cast("string"), p.y.cast("string")),
                    )
                ),
            )
        ),
    )
    return F.when(parts.isNotNull(), F.concat(F.lit("MULTIPOLYGON "), joined(rings)))
