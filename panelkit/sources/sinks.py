"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import arrange
from .delimited import NA
from .geojson import polygon_wkt


def write_panel_csv(
    df: DataFrame,
    path: str,
    na: str = NA,
    order: Sequence[str] = (),
    one_file: bool = False,
    mode: str = "errorifexists",
) -> None:
    """CSV with a header, missing values as ``na`` and flags as TRUE / FALSE.

    ``one_file`` is for small tables only: it writes through a single task.
    """
    flags = {c: F.upper(F.col(c).cast("string")) for c, t in df.dtypes if t == "boolean"}
    if order:
        df = arrange(df, *order)
    if flags:
        df = df.withColumns(flags)
    if one_file:
        df = df.coalesce(1)
    df.write.mode(mode).option("header", True).option("nullValue", na).csv(path)


def write_polygons(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with the polygon arrays and box columns, plus a ``wkt`` column for other tools."""
    df.withColumn("wkt", polygon_wkt(F.col("parts"))).write.mode(mode).parquet(path)
