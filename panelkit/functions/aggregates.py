"""Aggregates with explicit missing-value rules. All combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_present(col: Column) -> Column:
    return F.count(col)


def sum_lenient(col: Column) -> Column:
    """Sum of what is there; 0 when nothing is."""
    return F.coalesce(F.sum(col), F.lit(0))


def sum_strict(col: Column) -> Column:
    """Sum that is NULL as soon as one value of the group is missing."""
    return F.when(F.count(col) == F.count(F.lit(1)), F.sum(col))


def any3(flag: Column) -> Column:
    """Three-valued ANY: TRUE wins, else NULL if a flag is missing, else FALSE."""
    return (
        F.when(F.bool_or(flag), True)
        .when(F.count(flag) < F.count(F.lit(1)), F.lit(None))
        .otherwise(False)
    )
