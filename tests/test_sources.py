"""Readers and writers on small files."""

import bz2
import gzip
import json
import os
import random
import re
import zlib

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from panelkit import plans
from panelkit import sources as src
from panelkit.sources.faults import can_be_decoded


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_catalogue(spark, rows):
    files = spark.createDataFrame(
        [("d1", 1, "readme.txt", "p1"), ("d1", 2, "fts_a.csv", "p2"), ("d1", 3, "fts_b.csv", "p3"),
         ("d2", 1, "fts_c.csv", "p4"), ("d3", 1, "other.csv", "p5")],
        "dataset string, position int, name string, path string",
    )
    picked = src.pick_files(files, "fts_[a-z].csv")
    assert rows(picked, "dataset", "path") == [("d1", "p2"), ("d2", "p4")]
    assert rows(src.pick_files(files, nth=3), "path") == [("p3",)]
    assert rows(src.first_datasets(files, 1), "path") == [("p1",), ("p2",), ("p3",)]
    assert src.picked_paths(picked) == ["p2", "p4"]
    with pytest.raises(ValueError, match="more than 1"):
        src.picked_paths(picked, rows=1)
    third = src.pick_files(files, nth=3)
    plan = third._sc._jvm.PythonSQLUtils.explainString(third._jdf.queryExecution(), "simple")
    assert plan.count("WindowGroupLimit") == 2


def test_drifting_files(spark, rows, tmp_path):
    paths = [
        write(tmp_path / "a.csv", "countryCode,year,funding\nAFG,2001,1.5\n"),
        write(tmp_path / "b.csv", "year,countryCode,funding,typeName\n2002,NA,x,7\n"),
        write(tmp_path / "c.csv", "countryCode,year,funding\nTCD,2003,\n"),
        str(tmp_path / "absent.csv"),
    ]
    bad = tmp_path / "d.csv.gz"
    bad.write_bytes(gzip.compress(b"countryCode,year,funding\n" + b"A,1,1\n" * 9000)[:60])
    cut = tmp_path / "e.csv.gz"  # most of it can be read
    whole = gzip.compress(b"countryCode,year,funding\n" + os.urandom(90_000).hex().encode())
    cut.write_bytes(whole[: len(whole) * 2 // 3])
    junk = write(tmp_path / "f.csv.gz", "countryCode,year,funding\nAFG,1,1\n")  # no gzip
    damaged = [str(bad), str(cut), junk]
    casts = {"year": "int", "funding": "double"}
    with pytest.warns(UserWarning, match="e.csv.gz"):
        df = src.read_drifting_csv(spark, paths + damaged, casts)
    assert set(src.file_headers(spark, paths + damaged)[1]) == {paths[3], *damaged}
    assert rows(df, "countryCode", "year", "funding", "typeName") == [
        ("AFG", 2001, 1.5, None), ("TCD", 2003, None, None), (None, 2002, None, "7"),
    ]
    assert src.readable_paths(spark, paths) == paths[:3]


def test_no_readable_file(spark, tmp_path):
    with pytest.warns(UserWarning):
        df = src.read_drifting_csv(spark, [str(tmp_path / "gone.csv")], {"year": "int"})
    assert df.columns == ["year"] and df.count() == 0
    with pytest.raises(Exception, match="gone.csv"):
        src.read_drifting_csv(spark, [str(tmp_path / "gone.csv")], skip_corrupt=False)


def test_catalogue_has_no_default_limit(spark):
    files = spark.range(700).selectExpr("concat('d', id) AS dataset", "1 AS position", "'n' AS name", "concat('p', id) AS path")
    picked = src.pick_files(src.first_datasets(files))
    assert len(src.picked_paths(picked)) == 700
    assert src.first_datasets(files, 600).count() == 600


def test_catalogue_to_panel(spark, rows, tmp_path):
    """From a catalogue of files to the gap-free funding panel."""
    entries = []
    for i, (name, text) in enumerate({
        "fts_afg.csv": "countryCode,year,requirements,funding,typeName\nAFG,2001,5,NA,7\nAFG,2001,5,NA,7\n",
        "fts_tcd.csv": "countryCode,year,requirements,funding\nTCD,2000,1.25,1\n",
        "fts_mli.csv": "funding,countryCode,year,requirements,typeName\n2,MLI,1999,3,x\n",
    }.items()):
        entries.append((f"d{i}", 1, "notes.txt", str(tmp_path / "nowhere.txt")))
        entries.append((f"d{i}", 2, name, write(tmp_path / name, text)))
    entries.append(("d9", 1, "fts_gon.csv", str(tmp_path / "gone.csv")))
    files = spark.createDataFrame(
        entries, "dataset string, position int, name string, path string")
    casts = {"year": "int", "requirements": "double", "funding": "double"}
    raw = src.read_first_matches(spark, files, "fts_[a-z]{3}.csv", casts)
    panel = plans.funding_panel(raw, 2000, 2001)
    assert rows(panel) == [
        ("AFG", 2000, 0.0, 0.0), ("AFG", 2001, 5.0, 0.0),
        ("MLI", 1999, 3.0, 2.0), ("MLI", 2000, 0.0, 0.0), ("MLI", 2001, 0.0, 0.0),
        ("TCD", 2000, 1.25, 1.0), ("TCD", 2001, 0.0, 0.0),
    ]


def test_corrupt_file_is_skipped(spark, rows, tmp_path):
    good = tmp_path / "a.csv.gz"
    good.write_bytes(gzip.compress(b"k,v\nA,1\n"))
    bad = tmp_path / "b.csv.gz"
    bad.write_bytes(b"this is not gzip")
    df = src.read_table(spark, [str(good), str(bad)], "k string, v int", skip_corrupt=True)
    assert rows(df) == [("A", 1)]


def test_possibly(spark):
    read = src.possibly(lambda p: spark.read.text(p))
    assert read("/no/such/file") is None


def test_missing_marks(spark, rows, tmp_path):
    path = write(tmp_path / "m.csv", 'k,v,b\nNA,1,TRUE\n,2,FALSE\n"",3,NA\n')
    assert rows(src.read_table(spark, path, "k string, v int, b boolean"), "v", "k", "b") == [
        (1, None, True), (2, None, False), (3, "", None),
    ]
    inferred = src.read_table(spark, path)
    assert dict(inferred.dtypes) == {"k": "string", "v": "int", "b": "boolean"}


def test_preamble(spark, rows, tmp_path):
    text = "INFORM severity,,\nCOUNTRY,ISO3,DRIVERS\n(a-z),(code),\n,,x\nChad,TCD,Floods\nMali,MLI,NA\n"
    path = write(tmp_path / "s.csv", text)
    df = src.read_with_preamble(spark, path, ["COUNTRY", "ISO3", "DRIVERS"], "ISO3", "^[A-Z]{3}$")
    # 'ISO' codes only: the header cell ISO3 has a digit, units are in parentheses
    assert rows(df, "ISO3", "DRIVERS") == [("MLI", None), ("TCD", "Floods")]


def test_key_file_with_crlf(spark, rows, tmp_path):
    path = write(tmp_path / "k.csv", "shapeID,adm1_Pcode\r\nS-1,AF01\r\nS-2,AF02")
    assert rows(src.read_key_file(spark, path, "shapeID", "adm1_Pcode")) == [
        ("S-1", "AF01"), ("S-2", "AF02"),
    ]


def test_geojson_files(spark, rows, tmp_path):
    feature = {"type": "Feature", "properties": {"iso3": "AAA", "n": 5, "region": None},
               "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}
    point = {"type": "Feature", "properties": {"iso3": "PPP"},
             "geometry": {"type": "Point", "coordinates": [0, 0]}}
    nothing = {"type": "Feature", "properties": {"iso3": "NUL"}, "geometry": None}
    features = [feature, point, nothing]
    whole = write(tmp_path / "w.geojson", json.dumps(
        {"type": "FeatureCollection", "features": features}, indent=1))
    lines = write(tmp_path / "l.geojson", "\n".join(json.dumps(f) for f in features))
    wanted = {"iso3": "string", "n": "int", "region": "string"}
    a = src.read_geojson(spark, whole, wanted)
    b = src.read_geojson(spark, lines, wanted, lines=True)
    assert a.columns == b.columns
    expected = [("AAA", 5, None, 3), ("NUL", None, None, None), ("PPP", None, None, None)]
    for df in (a, b):
        sized = df.withColumn("n_edges", F.expr("if(edges is null, null, size(edges))"))
        assert rows(sized, "iso3", "n", "region", "n_edges") == expected


def test_panel_csv_round_trip(spark, rows, tmp_path):
    schema = "iso3 string, year int, funding double, hrp boolean"
    data = [("AFG", 2000, 1e20, True), (None, 2001, None, None), ("TCD", 2002, float("inf"), False)]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "panel")
    src.write_panel_csv(df, path, order=["iso3", "year"], one_file=True)
    text = "".join(p.read_text() for p in (tmp_path / "panel").glob("part-*.csv"))
    assert text.splitlines()[0] == "iso3,year,funding,hrp"
    assert text.splitlines()[-1] == "NA,2001,NA,NA" and "TRUE" in text
    assert rows(src.read_table(spark, path, schema)) == rows(df)


def test_polygons_round_trip(spark, tmp_path):
    text = json.dumps({"properties": {"id": "a"}, "geometry": {
        "type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}})
    df = src.parse_features(spark.createDataFrame([(text,)], "f string"), "f", {"id": "string"})
    src.write_polygons(df, str(tmp_path / "p"))
    row = spark.read.parquet(str(tmp_path / "p")).first()
    assert row["wkt"].startswith("MULTIPOLYGON (((0.0 0.0") and len(row["edges"]) == 3


def test_damage_is_told_from_passing_failures(spark, tmp_path, monkeypatch):
    good = write(tmp_path / "a.csv", "k,v\nA,1\n")
    packed = tmp_path / "b.csv.gz"
    packed.write_bytes(gzip.compress(b"k,v\nB,2\n"))
    paths = [good, str(packed)]
    kind = type(spark.read.text(good))
    collect, calls = kind.collect, []

    def failing(message):
        def fail(self, *args):
            calls.append(message)
            raise PySparkException(message)
        return fail

    for message in (
        "Job aborted due to stage failure: ExecutorLostFailure (executor 3 exited)",
        "java.lang.OutOfMemoryError: Java heap space",
        # the file is said to be bad, but it is not
        "[FAILED_READ_FILE.NO_HINT] Encountered error while reading file: Connection reset",
    ):
        first = iter([failing(message)])
        monkeypatch.setattr(kind, "collect", lambda self, *a: next(first, collect)(self, *a))
        with pytest.raises(PySparkException, match=re.escape(message[:30])):
            src.file_headers(spark, paths)
        monkeypatch.setattr(kind, "collect", collect)
    assert len(calls) == 3
    assert src.file_headers(spark, paths)[1] == []
    assert src.fault(ValueError("[PATH_NOT_FOUND] x")) is None
    with pytest.raises(ValueError):
        src.possibly(lambda: int("x"))()
    with pytest.raises(AnalysisException):
        src.possibly(lambda: spark.sql("SELECT nothing_like_it"))()


def test_many_bad_files_need_few_jobs(spark, tmp_path):
    paths = []
    for n in range(120):
        path = tmp_path / f"f{n:03}.csv.gz"
        data = gzip.compress(b"k,v\n" + f"{n},1\n".encode() * 400)
        path.write_bytes(data[: len(data) // 2] if n % 6 == 0 else data)
        paths.append(str(path))
    context = spark.sparkContext
    context.setJobGroup("headers", "headers of many files")
    try:
        headers, bad = src.file_headers(spark, [*paths, str(tmp_path / "gone.csv")])
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(headers) == 100 and len(bad) == 21
    assert set(bad) == {*paths[::6], str(tmp_path / "gone.csv")}
    assert len(context.statusTracker().getJobIdsForGroup("headers")) < 16


def test_files_that_cannot_be_decoded():
    data = os.urandom(5000)
    for ending, packed in ((".gz", gzip.compress(data)), (".bz2", bz2.compress(data)),
                           (".deflate", zlib.compress(data))):
        name = "f.csv" + ending
        assert can_be_decoded(name, packed)
        assert not can_be_decoded(name, packed[:-20]) and not can_be_decoded(name, packed[:9])
        assert not can_be_decoded(name, b"plain text") and not can_be_decoded(name, b"")
    flipped = bytearray(gzip.compress(data))
    flipped[-6] ^= 1  # the checksum
    assert not can_be_decoded("f.gz", bytes(flipped))
    assert can_be_decoded("f.gz", gzip.compress(b"a") + gzip.compress(b"b"))


@pytest.fixture
def small_blocks(spark):
    """Files are split every few hundred bytes."""
    options = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "10"}
    for name, value in options.items():
        spark.conf.set(name, value)
    yield
    for name in options:
        spark.conf.unset(name)


def test_lines_are_numbered_over_all_splits(spark, rows, tmp_path, small_blocks):
    sizes = {"one": 300, "two": 1, "three": 120, "none": 0}
    for name, n in sizes.items():
        write(tmp_path / f"{name}.txt", "".join(f"{name} {i}\r\n" for i in range(n)))
    numbered = src.number_lines(src.file_lines(spark, str(tmp_path)))
    assert numbered.select("path", "block").distinct().count() > 4
    found = {(r["path"].split("/")[-1][:-4], r["line"], r["value"]) for r in numbered.collect()}
    assert found == {(k, i, f"{k} {i}") for k, n in sizes.items() for i in range(n)}


def test_sheets_lose_the_lines_above_their_rows(spark, rows, tmp_path, small_blocks):
    body = "".join(f"K{i},{'NA' if i % 7 == 0 else i}\n" for i in range(400))
    write(tmp_path / "a.csv", "Title, of all\n﻿ISO3,n\n(code),(x)\n\n,\n" + body)
    write(tmp_path / "b.csv", 'Title\nn,note,ISO3\n-,-,-\n=,=,=\n5,"a, b",K500\n')
    write(tmp_path / "c.csv", "only a title\n")
    df = src.read_sheet(spark, str(tmp_path), skip=1, drop=2)
    assert rows(df, "ISO3", "n", "note") == sorted(
        [(f"K{i}", None if i % 7 == 0 else str(i), None) for i in range(400)] + [("K500", "5", "a, b")],
        key=lambda r: tuple((v is None, str(v)) for v in r))
    assert src.read_sheet(spark, str(tmp_path / "c.csv"), skip=1).count() == 0


def test_a_collection_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    draw = random.Random(2)
    odd = ["{", "}", '"Feature"', "\\", '\\"', "a}b{c", "[{", "é😀", "\n", '"}', "]", ","]

    def feature(i):
        ring = [[i, 0], [i + 1, 0], [i + 1, draw.random()], [i, 0]]
        out = {"type": "Feature", "properties": {"id": str(i), "note": "".join(draw.choices(odd, k=i % 6))},
               "geometry": {"type": "Polygon", "coordinates": [ring]} if i % 5 else None}
        return dict(reversed(out.items())) if i % 3 == 0 else out

    features = [feature(i) for i in range(60)]
    features[30]["properties"]["note"] = "}" * 2500  # longer than a block
    other = {"type": "name", "properties": {"name": "urn}{"}}
    document = {"type": "FeatureCollection", "crs": other, "bbox": [0, 0, 1, 1], "meta": {"a": {"b": [{}]}},
                "features": features, "tail": {"x": {}}}
    for n, (indent, ascii_only) in enumerate([(None, True), (2, False)]):
        path = write(tmp_path / f"{n}.geojson", json.dumps(document, indent=indent, ensure_ascii=ascii_only))
        found = src.read_geojson(spark, path, {"id": "string", "note": "string"}).collect()
        assert sorted((r["id"], r["note"], r["xmin"]) for r in found) == sorted(
            (f["properties"]["id"], f["properties"]["note"],
             float(f["properties"]["id"]) if f["geometry"] else None) for f in features)
    pieces = src.file_lines(spark, path, "}")
    assert pieces.select("block").distinct().count() > 8
    empty = write(tmp_path / "empty.geojson", '{"type": "FeatureCollection", "features": []}')
    assert src.read_geojson(spark, empty, {"id": "string"}).count() == 0


def test_files_of_folders(spark, rows, tmp_path):
    for name in ("b/2.csv", "b/1.csv", "a/x/9.csv", "a/x/8.txt", "b/3.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        write(tmp_path / name, "k\n")
    files = src.list_files(spark, str(tmp_path))
    assert rows(files, "dataset", "name", "length") == [
        ("b", "1.csv", 2), ("b", "2.csv", 2), ("b", "3.csv", 2), ("x", "8.txt", 2), ("x", "9.csv", 2)]
    assert rows(src.pick_files(files, "csv$", nth=2), "name") == [("2.csv",)]
    assert src.list_files(spark, str(tmp_path), "*.txt").count() == 1
