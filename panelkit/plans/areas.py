"""Polygons with attributes, incidents and people in need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import sum_lenient
from ..functions.numbers import share
from ..operators.aggregate import lenient_sum, measure_present, measure_rows
from ..operators.joins import left_join
from ..operators.spatial import count_in_polygons

MEASURES = {
    "conflict_events": measure_present("best"),
    "best": lenient_sum("best"),
    "deaths_civilians": lenient_sum("deaths_civilians"),
}


def enrich_polygons(
    polygons: DataFrame,
    severity: DataFrame,
    incidents: DataFrame,
    id_col: str,
    year: int | None = 2021,
    iso3: str = "iso3",
    cell: float = 1.0,
    **options,
) -> DataFrame:
    """Polygons with the severity of their country and the incidents of a year inside them.

    Polygon columns that incidents have too are the polygon's. ``year`` None takes all years.
    """
    rows = incidents if year is None else incidents.where(F.col("year") == year)
    points = rows.select("longitude", "latitude", "best", "deaths_civilians")
    counted = count_in_polygons(polygons, points, id_col, MEASURES, cell=cell, **options)
    joined = left_join(counted, severity, iso3)
    attributes = [c for c in joined.columns if c not in MEASURES]
    return joined.select(*attributes, *MEASURES)


def events_by_area(
    polygons: DataFrame,
    incidents: DataFrame,
    key_file: DataFrame,
    id_col: str = "shapeID",
    area: str = "adm1_Pcode",
    cell: float = 1.0,
    **options,
) -> DataFrame:
    """(shape id, area code, events) with the code looked up in a key file; 0 for no events."""
    points = incidents.select("longitude", "latitude")
    counted = count_in_polygons(
        polygons.select(id_col, "edges"),
        points,
        id_col,
        {"events": measure_rows()},
        cell=cell,
        **options,
    )
    return left_join(counted.select(id_col, "events"), key_file, id_col).select(
        id_col, area, "events"
    )


def percent_in_need(
    need: DataFrame, population: DataFrame, by: str, pin: str = "pin", people: str = "population"
) -> DataFrame:
    """(by, pin, population, pin_pct): 100 * people in need / population of each area.

    Both sides are summed per area first; areas without a population have no percentage.
    """
    needed = need.groupBy(by).agg(sum_lenient(F.col(pin)).alias(pin))
    counted = population.groupBy(by).agg(F.sum(people).alias(people))
    return left_join(needed, counted, by).withColumn(
        "pin_pct", 100 * share(F.col(pin), F.col(people))
    )


def area_need(events: DataFrame, need: DataFrame, area: str = "adm1_Pcode") -> DataFrame:
    """Events and percentage in need of the same area side by side."""
    return left_join(events, need, area)
