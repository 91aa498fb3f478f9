"""Stacking tables by column name, after repairing columns whose type drifts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def harmonise(
    tables: Iterable[DataFrame | None], casts: Mapping[str, str]
) -> list[DataFrame]:
    """Cast the named columns where they exist, and leave out the tables that are None."""
    out = []
    for table in tables:
        if table is None:
            continue
        found = {c: F.col(c).cast(t) for c, t in casts.items() if c in table.columns}
        out.append(table.withColumns(found) if found else table)
    return out


def bind_rows(*tables: DataFrame | None) -> DataFrame:
    """Union-all by name; absent columns are NULL; None is skipped.

    A column that is text in one table and a number in another is an error here: Spark would
    widen it to a number and fail only on the rows that are not numeric.
    """
    found = [t for t in tables if t is not None]
    if not found:
        raise ValueError("no table to bind")
    kinds: dict[str, str] = {}
    for table in found:
        for name, kind in table.dtypes:
            if kind == "void":
                continue
            if "string" in {kind, kinds.setdefault(name, kind)} and kinds[name] != kind:
                raise TypeError(f"column {name!r} is {kinds[name]} and {kind}; harmonise first")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; missing values are equal. Copies collapse before the shuffle."""
    return df.distinct()
