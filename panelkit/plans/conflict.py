"""Incidents per country and year, and moving a part of one country to another."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import is_present, not_in
from ..operators.aggregate import complete_sum, measure_rows, summarise, summarise_through
from ..operators.bind import bind_rows
from ..operators.columns import drop_suffix
from ..operators.complete import complete
from ..operators.joins import left_join
from ..operators.recode import recode
from ..operators.spatial import keep_inside
from ..operators.staging import settle

MEASURES = {"events": measure_rows(), "fatalities": complete_sum("best")}


def conflict_panel(
    incidents: DataFrame,
    dictionary: DataFrame,
    overrides: Mapping[object, str] | None = None,
    start: int = 1989,
    stop: int = 2022,
    keys: DataFrame | None = None,
    code: str = "country_id",
) -> DataFrame:
    """(iso3, year, events, fatalities) of incidents (``code``, year, best), gaps filled with 0.

    ``dictionary`` maps the code to iso3, after ``overrides``; incidents without a country are
    left out. ``keys`` (iso3) adds the countries of another table.

    Incidents are counted by their raw code first. What meets the dictionary is one row per
    code and year, so neither its size nor a very frequent code matters.
    """

    def relabel(partial: DataFrame) -> DataFrame:
        coded = recode(partial, code, dictionary, "iso3", overrides)
        return coded.where(is_present(F.col("iso3")))

    panel = summarise_through(incidents, [code, "year"], relabel, ["iso3", "year"], MEASURES)
    return complete(
        panel,
        ["iso3"],
        "year",
        start,
        stop,
        fill={"events": 0, "fatalities": 0},
        keys=keys,
        summarised=True,
    )


def carve_out(
    panel: DataFrame,
    incidents: DataFrame,
    in_parent: Column,
    polygons: DataFrame,
    polygon_id: str,
    parent: str,
    child: str,
    start: int = 1989,
    stop: int = 2022,
    strict_gaps: bool = False,
    cell: float = 1.0,
) -> DataFrame:
    """Move the parent's incidents that lie in the polygons to the child.

    The child's rows are replaced by what was found, and the parent's are lowered by it (NULL
    in years the child does not cover). With ``strict_gaps`` the child's gap years have no
    entity; by default they are the child's.
    """
    inside = keep_inside(incidents.where(in_parent), polygons, polygon_id, cell=cell)
    # a row per year, which both halves of the answer read
    found = settle(
        summarise(inside.withColumn("iso3", F.lit(child)), ["iso3", "year"], MEASURES)
    )
    moved = complete(
        found,
        [],
        "year",
        start,
        stop,
        fill={"events": 0, "fatalities": 0},
        constants=None if strict_gaps else {"iso3": child},
        summarised=True,
    )
    taken = moved.select(
        F.lit(parent).alias("iso3"),
        "year",
        F.col("events").alias("events_taken"),
        F.col("fatalities").alias("fatalities_taken"),
    )
    # one pass over the panel: the join touches only the parent's rows
    rest = left_join(panel.where(not_in(F.col("iso3"), [child])), taken, ["iso3", "year"])
    is_parent = F.coalesce(F.col("iso3") == parent, F.lit(False))
    rest = rest.withColumns(
        {
            c: F.when(is_parent, F.col(c) - F.col(f"{c}_taken")).otherwise(F.col(c))
            for c in ("events", "fatalities")
        }
    )
    return bind_rows(drop_suffix(rest, "_taken"), moved.select(*panel.columns))
