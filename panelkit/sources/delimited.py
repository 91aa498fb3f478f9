"""Delimited text: tolerant, drifting and preamble-laden files."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bind import bind_rows
from ..operators.rows import first_rows
from .faults import fault, same_names, sort_files
from .lines import file_lines, number_lines

NA = "NA"
# Spark's error conditions for sources without a usable schema.
NO_SCHEMA = ("UNABLE_TO_INFER_SCHEMA", "EMPTY_SCHEMA_NOT_SUPPORTED_FOR_DATASOURCE")


def possibly(read: Callable, otherwise=None) -> Callable:
    """A reader that returns ``otherwise`` where the source is absent or has no usable schema.

    Any other failure is raised: it says nothing about the source.
    """

    def attempt(*args, **kwargs):
        try:
            return read(*args, **kwargs)
        except AnalysisException as error:
            if fault(error) == "absent" or error.getCondition() in NO_SCHEMA:
                return otherwise
            raise

    return attempt


def readable_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist. Absent ones must go before a multi-path read, which would fail."""
    probe = possibly(lambda p: spark.read.text(p))
    return [p for p in paths if probe(p) is not None]


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    na: str = NA,
    skip_corrupt: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header. ``na`` and unquoted empty fields are NULL, and bad fields too.

    Give a schema for anything large: inference reads the data twice. ``skip_corrupt`` goes on
    after a file that cannot be decoded, with the rows before the damage; to leave such files
    out whole, take only those that ``file_headers`` returns.
    """
    reader = (
        spark.read.option("header", True)
        .option("nullValue", na)
        .option("mode", "PERMISSIVE")
        .option("ignoreCorruptFiles", skip_corrupt)
        .options(**options)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def file_headers(
    spark: SparkSession, paths: Sequence[str], skip: bool = True
) -> tuple[dict[str, str], list[str]]:
    """The first line of each file that can be read to its end, and the paths that cannot.

    One job reads all files. Only if a file is absent or cannot be decoded, the files are looked
    at one by one (in one job more, see ``sort_files``) and the bad ones left out whole, however
    many they are. What is not the fault of a file is raised, and so is everything with ``skip``
    off. Of a folder only the damaged files are left out. Empty files have no first line.
    """
    given, good, bad = list(paths), list(paths), []
    while good:
        try:
            return _first_lines(spark, good), bad
        except (PySparkException, Py4JJavaError) as error:
            kind = fault(error)
            if not skip or kind is None:
                raise
            there = readable_paths(spark, good)
            gone = [p for p in good if p not in set(there)]
            sound, damaged = sort_files(spark, there) if kind == "unread" and there else (there, [])
            if not gone and not damaged:  # the files are in order, so the failure is none of theirs
                raise
            good, bad = sound, bad + gone + same_names(damaged, given)
    return {}, bad


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    lines = spark.read.option("ignoreCorruptFiles", False).text(list(paths))
    numbered = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = numbered.groupBy("path").agg(F.min_by("value", F.struct("block", "row")).alias("line"))
    return {unquote(r["path"]): r["line"] for r in first.collect()}


def read_drifting_csv(
    spark: SparkSession,
    paths: Sequence[str],
    casts: Mapping[str, str] | None = None,
    na: str = NA,
    skip_corrupt: bool = True,
    file: str | None = None,
) -> DataFrame:
    """Many CSV files whose columns differ, as one table.

    Spark applies one schema by position to all paths of a read, so files are first grouped by
    their header, each layout is read once as text, and the layouts are stacked by name. Absent
    and damaged files are left out whole and named in a warning, or raise an error if
    ``skip_corrupt`` is off; a read that fails for another reason is an error always. Without any readable file the table is empty and has the columns
    of ``casts``, which turns text into types; what does not fit is NULL. ``file`` names a
    column for the path of the file that a row comes from.
    """
    headers, bad = file_headers(spark, list(paths), skip_corrupt)
    if bad:
        warnings.warn(f"left out unreadable files: {', '.join(bad)}", stacklevel=2)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(headers.items()):
        header = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))
        if any(header):
            layouts.setdefault(header, []).append(path)
    if not layouts:
        kinds = {**(casts or {}), **({file: "string"} if file else {})}
        kinds = ", ".join(f"`{c}` {t}" for c, t in kinds.items())
        return spark.createDataFrame([], kinds or T.StructType([]))
    tables = []
    for header, members in layouts.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        rows = read_table(spark, members, schema, na)
        tables.append(rows.withColumn(file, F.col("_metadata.file_path")) if file else rows)
    table = bind_rows(*tables)
    changed = {
        c: F.col(c).try_cast(t) for c, t in (casts or {}).items() if c in table.columns
    }
    return table.withColumns(changed) if changed else table


def read_with_preamble(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    key: str,
    key_pattern: str,
    na: str = NA,
    **options,
) -> DataFrame:
    """Exported sheets with title, header and unit lines above the data, all columns text.

    A line is data if its key column matches ``key_pattern`` (e.g. ``^[A-Z]{3}$``). That drops
    every line of the preamble wherever Spark splits the file, and needs no line numbers.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", False).option("nullValue", na)
    rows = reader.options(**options).csv(paths if isinstance(paths, str) else list(paths))
    return rows.where(F.col(key).rlike(key_pattern))


def read_sheet(
    spark: SparkSession,
    paths: str | Sequence[str],
    skip: int = 0,
    drop: int = 0,
    na: str = NA,
    **options,
) -> DataFrame:
    """Exported sheets by line number, all columns text: ``skip`` lines, a header, ``drop`` rows.

    Lines are numbered per file over all its splits, so only the lines above the data go. Blank
    lines after the skipped ones are no rows. Sheets with other headers are stacked by name. A
    sheet of a workbook is a file of its own here; choose it by its name.
    """
    numbered = number_lines(file_lines(spark, paths)).where(F.trim("value") != "")
    # the header and the dropped rows: a few lines of each file
    top = first_rows(numbered.where(F.col("line") >= skip), drop + 1, ["path"], ["line"])
    heads: dict[str, tuple[int, str]] = {}
    for row in top.select("path", "line", "value").collect():
        line, value = heads.get(row["path"], (row["line"], row["value"]))
        first = min((line, value), (row["line"], row["value"]))
        heads[row["path"]] = first
    last = top.groupBy("path").agg(F.max("line").alias("__last"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, (_, line) in sorted(heads.items()):
        separator = options.get("sep", ",")
        header = next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator), [])
        layouts.setdefault(tuple(header), []).append(path)
    if not layouts:
        return spark.createDataFrame([], T.StructType([]))
    number = {path: n for n, (_, paths) in enumerate(layouts.items()) for path in paths}
    # a row per file
    of_file = spark.createDataFrame(list(number.items()), "path string, __layout int")
    last = F.broadcast(last.join(F.broadcast(of_file), "path"))
    rows = numbered.join(last, "path").where(F.col("line") > F.col("__last"))
    tables = []
    for n, header in enumerate(layouts):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        parsed = F.from_csv("value", schema.toDDL(), {"nullValue": na, **options})
        mine = rows.where(F.col("__layout") == n)
        tables.append(mine.select(parsed.alias("row")).select("row.*"))
    return bind_rows(*tables)


def read_key_file(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A two-column lookup file (either kind of line end) with its named columns as text."""
    rows = read_table(spark, path, schema=f"`{key}` string, `{value}` string")
    return rows.where(F.col(key).isNotNull())
