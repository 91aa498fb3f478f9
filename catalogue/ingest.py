"""Choosing, repairing and reading inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import functions as pf
from panelkit import operators as op
from panelkit import sources as src

from .common import CODED_ORDERS, Query, money, register, summarise_orders, table

QUERIES: dict[str, Query] = {}


def _page_files(spark, sf_dir):
    """Pages as files: host = dataset, page_id = position, url = name."""
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("dataset"),
        F.col("page_id").alias("position"),
        F.col("url").alias("name"),
    )


_FILES = """files AS (
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS dataset, page_id AS position,
         url AS name FROM pages)"""


@register(
    QUERIES,
    f"""WITH {_FILES}, hits AS (
      SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY position) AS k
      FROM files WHERE regexp_matches(name, '/en/[0-9]{{3}}'))
    SELECT dataset, position, name FROM hits WHERE k = 1""",
)
def src_catalog_first_match(spark, sf_dir):
    return src.pick_files(_page_files(spark, sf_dir), "/en/[0-9]{3}")


@register(
    QUERIES,
    f"""WITH {_FILES}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY position) AS k FROM files)
    SELECT dataset, position, name FROM numbered WHERE k = 3""",
)
def src_catalog_third_of_search(spark, sf_dir):
    """Without a limit all datasets are searched."""
    return src.pick_files(src.first_datasets(_page_files(spark, sf_dir)), nth=3)


@register(
    QUERIES,
    f"""WITH {_FILES}, found AS (
      SELECT dataset FROM files GROUP BY dataset ORDER BY dataset LIMIT 5),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY position) AS k
      FROM files WHERE dataset IN (SELECT dataset FROM found))
    SELECT dataset, position, name FROM numbered WHERE k = 1""",
)
def src_search_limit(spark, sf_dir):
    """A search that the caller limits to five datasets."""
    return src.pick_files(src.first_datasets(_page_files(spark, sf_dir), rows=5))


@register(
    QUERIES,
    """WITH bound AS (
      SELECT c_nationkey AS country, c_mktsegment AS "typeName" FROM customer
      UNION ALL SELECT s_nationkey, CAST(s_nationkey AS VARCHAR) FROM supplier
      UNION ALL SELECT s_nationkey, NULL FROM supplier
      UNION ALL SELECT c_nationkey, c_mktsegment FROM customer)
    SELECT DISTINCT country, "typeName" FROM bound""",
)
def src_drift_union_distinct(spark, sf_dir):
    """Four tables whose typeName is text, a number, absent, and a copy of the first."""
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "country")
    text = customer.select(
        F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("typeName")
    )
    number = supplier.select(F.col("country").alias("typeName"), "country")
    absent = supplier.select("country")
    tables = op.harmonise([text, number, None, absent, text], {"typeName": "string"})
    return op.distinct_rows(op.bind_rows(*tables))


@register(
    QUERIES,
    """SELECT event_id, CAST(user_id AS DOUBLE) AS whole, value AS number,
      CAST(ts AS DATE) AS day, event_type = 'error' AS flag,
      lpad(CAST(user_id AS VARCHAR), 6, '0') AS code,
      CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS label
    FROM events""",
)
def src_type_convert(spark, sf_dir):
    """Columns turned into text, as a sheet would give them, get their types back."""
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("whole"),
        F.concat(F.lit(" "), F.col("value").cast("string")).alias("number"),
        F.to_date("ts").cast("string").alias("day"),
        F.when(F.col("event_type") == "error", "T").otherwise("F").alias("flag"),
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("code"),
        F.when(F.col("event_type") == "click", "NA")
        .otherwise(F.col("event_type"))
        .alias("label"),
    )
    return op.retype(text)


@register(
    QUERIES,
    """SELECT event_id, ts AS stamp,
      CASE WHEN event_type = 'click' THEN date_trunc('day', ts) ELSE ts END AS mixed,
      CASE WHEN event_type = 'error' THEN 'none' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS noted
    FROM events""",
)
def src_type_convert_times(spark, sf_dir):
    """Moments, and dates among moments, written as text get their type back; notes stay text."""
    day = F.to_date("ts").cast("string")
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("string").alias("stamp"),
        F.when(F.col("event_type") == "click", day).otherwise(F.col("ts").cast("string")).alias("mixed"),
        F.when(F.col("event_type") == "error", "none").otherwise(day).alias("noted"),
    )
    return op.retype(text)


@register(
    QUERIES,
    """SELECT conv_id, turn, role, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
    WHERE k > 2""",
)
def src_preamble_drop(spark, sf_dir):
    """Each conversation is a file with two lines of preamble."""
    return op.drop_first_rows(table(spark, sf_dir, "conversations"), 2, ["conv_id"], ["turn"])


def _supplier_shapes(spark, sf_dir):
    """One GeoJSON feature per supplier: a triangle, for some nations with a second part."""
    x, y = F.col("s_nationkey") * F.lit(4.0), F.col("s_acctbal") / 100

    def ring(dx, dy):
        corners = [(0, 0), (3, 0), (3, 2), (0, 0)]
        points = [F.array(x + float(a + dx), y + float(b + dy)) for a, b in corners]
        return F.array(*points)

    single = F.to_json(F.array(ring(0, 0)))
    double = F.to_json(F.array(F.array(ring(0, 0)), F.array(ring(10, 10))))
    geometry = F.when(
        F.col("s_nationkey") < 12, F.concat(F.lit('{"type":"Polygon","coordinates":'), single)
    ).otherwise(F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), double))
    return table(spark, sf_dir, "supplier").select(
        F.concat(
            F.lit('{"type":"Feature","properties":{"supplier":'),
            F.col("s_suppkey").cast("string"),
            F.lit(',"name":"'),
            F.col("s_name"),
            F.lit('"},"geometry":'),
            geometry,
            F.lit("}}"),
        ).alias("feature")
    )


@register(
    QUERIES,
    """WITH base AS (
      SELECT s_suppkey AS supplier, s_name AS name, s_nationkey AS k,
             s_nationkey * CAST(4 AS DOUBLE) AS x, s_acctbal / 100 AS y FROM supplier),
    shift AS (SELECT *, 0.0::DOUBLE AS d FROM base
      UNION ALL SELECT *, 10.0::DOUBLE FROM base WHERE k >= 12)
    SELECT supplier, name, x + d AS x1, y + d AS y1, x + (3 + d) AS x2, y + d AS y2 FROM shift
    UNION ALL SELECT supplier, name, x + (3 + d), y + d, x + (3 + d), y + (2 + d) FROM shift
    UNION ALL SELECT supplier, name, x + (3 + d), y + (2 + d), x + d, y + d FROM shift""",
)
def src_geojson_edges(spark, sf_dir):
    """Features parsed from text, polygons and multi-polygons, as segments."""
    shapes = src.parse_features(
        _supplier_shapes(spark, sf_dir), "feature", {"supplier": "bigint", "name": "string"}
    )
    return shapes.select("supplier", "name", F.inline("edges"))


@register(
    QUERIES,
    """WITH base AS (SELECT s_suppkey AS supplier, s_nationkey * CAST(4 AS DOUBLE) AS x,
        s_acctbal / 100 AS y, s_nationkey >= 12 AS two FROM supplier)
    SELECT supplier, x AS xmin, y AS ymin, CASE WHEN two THEN x + 13 ELSE x + 3 END AS xmax,
      CASE WHEN two THEN y + 12 ELSE y + 2 END AS ymax, CASE WHEN two THEN 2 ELSE 1 END AS n_parts
    FROM base""",
)
def src_geojson_boxes(spark, sf_dir):
    """Box and number of parts of parsed features."""
    shapes = src.parse_features(
        _supplier_shapes(spark, sf_dir), "feature", {"supplier": "bigint"}
    )
    return shapes.select(
        "supplier", "xmin", "ymin", "xmax", "ymax", F.size("parts").alias("n_parts")
    )


@register(
    QUERIES,
    """WITH parts AS (SELECT page_id, regexp_extract(url, '([^/]+)/?$', 1) AS segment FROM pages)
    SELECT page_id, segment, TRY_CAST(segment AS DOUBLE) AS number FROM parts""",
)
def scl_lenient_number(spark, sf_dir):
    """Last part of a url as a number where it is one."""
    segment = F.regexp_extract("url", "([^/]+)/?$", 1)
    return op.transmute(
        table(spark, sf_dir, "pages"),
        {"segment": segment},
        {"number": pf.to_number(F.col("segment"))},
        keep=["page_id"],
    )


@register(
    QUERIES,
    """SELECT lang, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS characters
    FROM (SELECT DISTINCT lang, text FROM documents) GROUP BY lang""",
)
def agg_distinct_rows(spark, sf_dir):
    """Copies of whole texts counted once."""
    texts = op.distinct_rows(table(spark, sf_dir, "documents").select("lang", "text"))
    return texts.groupBy("lang").agg(
        pf.n_rows().alias("texts"), F.sum(F.length("text")).alias("characters")
    )


@register(
    QUERIES,
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price FROM orders
    WHERE o_orderstatus IN ('F', 'O')""",
)
def src_select_files(spark, sf_dir):
    """Column pruning and a pushed filter on the table read."""
    orders = table(spark, sf_dir, "orders").where(pf.is_in(F.col("o_orderstatus"), ["F", "O"]))
    return orders.select("o_orderkey", money("o_totalprice").cast("double").alias("price"))


@register(
    QUERIES,
    """SELECT c_nationkey AS "countryCode", CAST(c_acctbal AS DOUBLE) AS funding,
      c_mktsegment AS "typeName" FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier
    UNION ALL SELECT s_nationkey, NULL, CAST(s_suppkey AS VARCHAR) FROM supplier""",
)
def src_drifting_files(spark, sf_dir):
    """CSV files with three different headers, and one that is not there, as one table."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    country = F.col("s_nationkey").alias("countryCode")
    tables = [
        customer.select(
            F.col("c_nationkey").alias("countryCode"),
            F.col("c_mktsegment").alias("typeName"),
            F.col("c_acctbal").alias("funding"),
        ),
        supplier.select(F.col("s_acctbal").alias("funding"), country),
        supplier.select(country, F.lit("none").alias("funding"),
                        F.col("s_suppkey").alias("typeName")),
    ]
    paths = [op.scratch_path(spark) for _ in tables]
    for df, path in zip(tables, paths):
        src.write_panel_csv(df, path)
    casts = {"countryCode": "int", "funding": "double"}
    return src.read_drifting_csv(spark, [*paths, op.scratch_path(spark)], casts)


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}
    SELECT code, year, count(*) AS n, sum(price)::DOUBLE AS total, count(*) > 500 AS many
    FROM coded GROUP BY code, year""",
)
def snk_csv_round_trip(spark, sf_dir):
    """A sorted panel with missing codes written as CSV and read back."""
    measures = {"n": op.measure_rows(), "total": op.lenient_sum("price")}
    panel = summarise_orders(spark, sf_dir, ["code", "year"], measures).withColumns(
        {"total": F.col("total").cast("double"), "many": F.col("n") > 500}
    )
    path = op.scratch_path(spark)
    src.write_panel_csv(panel, path, order=["code", "year"])
    return src.read_table(spark, path, panel.schema)


@register(
    QUERIES,
    """SELECT s_suppkey AS supplier, s_name AS name, CASE WHEN s_nationkey >= 12 THEN 6 ELSE 3 END
      AS n_edges, CASE WHEN s_nationkey >= 12 THEN 5 ELSE 3 END AS brackets FROM supplier""",
)
def snk_polygons_round_trip(spark, sf_dir):
    """Polygons written with their text form and read back."""
    shapes = src.parse_features(
        _supplier_shapes(spark, sf_dir), "feature", {"supplier": "bigint", "name": "string"}
    )
    path = op.scratch_path(spark)
    src.write_polygons(shapes, path)
    opened = F.length("wkt") - F.length(F.replace("wkt", F.lit("("), F.lit("")))
    return spark.read.parquet(path).select(
        "supplier", "name", F.size("edges").alias("n_edges"), opened.alias("brackets")
    )


def _segment_files(spark, sf_dir) -> str:
    """A folder per market segment with its customers: one sound CSV file, three bad ones, none.

    BUILDING is compressed and has a column more. The file of HOUSEHOLD is called compressed but
    is not, that of MACHINERY ends too early, and FURNITURE has no file.
    """
    folder = op.scratch_path(spark)
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("countryCode"), F.col("c_acctbal").alias("funding"),
        F.col("c_mktsegment").alias("typeName"),
    )
    for name in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"):
        part = customer.where(F.col("typeName") == name)
        part = part if name == "BUILDING" else part.drop("typeName")
        packed = name in ("BUILDING", "MACHINERY")
        part.coalesce(1).write.option("header", True).option(
            "compression", "gzip" if packed else "none"
        ).csv(f"{folder}/{name}")
    listed = src.list_files(spark, folder, "part-*")
    files = {r["dataset"]: r["path"] for r in listed.select("dataset", "path").collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    path = {name: hadoop.fs.Path(text) for name, text in files.items()}
    system = path["MACHINERY"].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.rename(path["HOUSEHOLD"], hadoop.fs.Path(f"{folder}/HOUSEHOLD/funding_all.csv.gz"))
    short = system.create(hadoop.fs.Path(f"{folder}/MACHINERY/funding_all.csv.gz"))
    whole = system.open(path["MACHINERY"])
    short.write(bytearray(whole.readNBytes(100)))
    whole.close()
    short.close()
    return folder


@register(
    QUERIES,
    """SELECT c_nationkey AS "countryCode", c_acctbal AS funding,
      CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS "typeName"
    FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')""",
)
def src_read_first_matches(spark, sf_dir):
    """The first funding file of each dataset; absent, mislabelled and short files are left out."""
    folder = _segment_files(spark, sf_dir)
    paths = {
        "AUTOMOBILE": "AUTOMOBILE", "BUILDING": "BUILDING", "FURNITURE": "FURNITURE",
        "HOUSEHOLD": "HOUSEHOLD/funding_all.csv.gz", "MACHINERY": "MACHINERY/funding_all.csv.gz",
    }
    rows = [(name, 1, "notes.txt", f"{folder}/nowhere") for name in paths]
    rows += [(name, 2, "funding_all.csv", f"{folder}/{path}") for name, path in paths.items()]
    rows += [(name, 3, "funding_old.csv", f"{folder}/nowhere") for name in paths]
    files = spark.createDataFrame(rows, "dataset string, position int, name string, path string")
    casts = {"countryCode": "int", "funding": "double"}
    return src.read_first_matches(spark, files, "funding_[a-z]{3}.csv", casts)


@register(
    QUERIES,
    """WITH placed AS (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price,
        'year=' || year(o_orderdate) AS dataset,
        row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1 AS place
      FROM orders)
    SELECT dataset, CASE WHEN place < 50 THEN 'first' ELSE 'third' END AS file, o_orderkey, price
    FROM placed WHERE place < 50 OR place BETWEEN 100 AND 149""",
)
def src_folder_files(spark, sf_dir):
    """Files chosen from folders by name and place: the first and the third of each year."""
    folder = op.scratch_path(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("year")
    )
    in_order = orders.repartition("year").sortWithinPartitions("year", "o_orderkey")
    in_order.write.partitionBy("year").option("header", True).option(
        "maxRecordsPerFile", 50
    ).csv(folder)
    files = src.list_files(spark, folder, "*.csv")
    casts = {"o_orderkey": "bigint", "price": "double"}
    tables = []
    for nth, name in ((1, "first"), (3, "third")):
        picked = src.pick_files(files, r"^part-.*\.csv$", nth=nth)
        read = src.read_drifting_csv(spark, src.picked_paths(picked), casts, file="path")
        dataset = F.regexp_extract("path", "/(year=[0-9]+)/", 1)
        tables.append(read.select(dataset.alias("dataset"), F.lit(name).alias("file"), "o_orderkey", "price"))
    return op.bind_rows(*tables)


def _text_files(lines, folder: str, **options) -> str:
    """A file per ``sheet`` of (sheet, place, value), its lines in order of place."""
    lines.repartition("sheet").sortWithinPartitions("sheet", "place").select(
        "value", "sheet"
    ).write.options(**options).partitionBy("sheet").text(folder)
    return folder


@register(
    QUERIES,
    """SELECT CAST(s_suppkey AS VARCHAR) AS supplier, s_name AS name,
      CASE WHEN s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance,
      CASE WHEN s_nationkey % 2 = 1 THEN CAST(s_nationkey AS VARCHAR) END AS country
    FROM supplier""",
)
def src_sheet_with_preamble(spark, sf_dir):
    """A sheet per nation: a title, a header (two kinds), units, a note, a blank line, the rows."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    odd = F.col("sheet") % 2 == 1
    balance = F.when(F.col("s_acctbal") >= 0, money("s_acctbal").cast("string")).otherwise("NA")
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    rows = supplier.withColumn("sheet", F.col("s_nationkey")).select(
        "sheet",
        F.col("s_suppkey").alias("place"),
        F.when(odd, F.concat_ws(",", balance, F.col("sheet"), name, key))
        .otherwise(F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit('"')), balance))
        .alias("value"),
    )
    above = [
        F.lit("Severity, all countries"),
        F.when(odd, "balance,country,name,supplier").otherwise("supplier,name,balance"),
        F.lit("(a-z),(text),,"),
        F.lit(""),
        F.lit("ISO,note,x"),
    ]
    top = nation.select(F.col("n_nationkey").alias("sheet")).select(
        "sheet", F.posexplode(F.array(*above)).alias("at", "value")
    )
    top = top.select("sheet", (F.col("at") - 10).cast("long").alias("place"), "value")
    folder = _text_files(top.unionByName(rows), op.scratch_path(spark))
    return src.read_sheet(spark, folder, skip=1, drop=2)


@register(
    QUERIES,
    """WITH base AS (
      SELECT s_suppkey AS supplier, s_name AS name, s_nationkey AS k,
             s_nationkey * CAST(4 AS DOUBLE) AS x, s_acctbal / 100 AS y FROM supplier),
    shift AS (SELECT *, 0.0::DOUBLE AS d FROM base
      UNION ALL SELECT *, 10.0::DOUBLE FROM base WHERE k >= 12)
    SELECT supplier, name, x + d AS x1, y + d AS y1, x + (3 + d) AS x2, y + d AS y2 FROM shift
    UNION ALL SELECT supplier, name, x + (3 + d), y + d, x + (3 + d), y + (2 + d) FROM shift
    UNION ALL SELECT supplier, name, x + (3 + d), y + (2 + d), x + d, y + d FROM shift""",
)
def src_read_geojson(spark, sf_dir):
    """Feature collections, one file for all nations of a kind, written and read by many tasks."""
    shapes = _supplier_shapes(spark, sf_dir).withColumns(
        {
            "place": F.get_json_object("feature", "$.properties.supplier").cast("long"),
            "sheet": F.get_json_object("feature", "$.geometry.type"),
        }
    )
    first = shapes.groupBy("sheet").agg(F.min("place").alias("least"))
    comma = F.when(F.col("place") == F.col("least"), "").otherwise(",")
    lines = shapes.join(F.broadcast(first), "sheet").select(
        "sheet", "place", F.concat(comma, F.col("feature")).alias("value")
    )
    head = '{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "a}{"}},'
    head += ' "features": ['
    ends = first.select(
        "sheet",
        F.explode(
            F.array(
                F.struct(F.lit(-1).cast("long").alias("place"), F.lit(head).alias("value")),
                F.struct(F.lit(2**62).alias("place"), F.lit("]}").alias("value")),
            )
        ).alias("end"),
    ).select("sheet", "end.*")
    folder = _text_files(lines.unionByName(ends), op.scratch_path(spark))
    areas = src.read_geojson(spark, folder, {"supplier": "bigint", "name": "string"})
    return areas.select("supplier", "name", F.inline("edges"))


@register(
    QUERIES,
    """SELECT 'S-' || s_suppkey AS "shapeID", s_name AS "adm1_Pcode" FROM supplier""",
)
def src_key_file(spark, sf_dir):
    """A key file with the line ends of another system."""
    rows = table(spark, sf_dir, "supplier").select(
        F.lit("keys").alias("sheet"),
        F.col("s_suppkey").alias("place"),
        F.concat(F.lit("S-"), F.col("s_suppkey").cast("string"), F.lit(","), "s_name").alias("value"),
    )
    head = spark.createDataFrame([("keys", -1, "shapeID,adm1_Pcode")], "sheet string, place long, value string")
    folder = _text_files(head.unionByName(rows), op.scratch_path(spark), lineSep="\r\n")
    return src.read_key_file(spark, f"{folder}/sheet=keys", "shapeID", "adm1_Pcode")
