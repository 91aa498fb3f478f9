"""Grouped measures that can be taken in one step or carried through a second grouping."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import count_present, n_rows, sum_lenient, sum_strict


class Measure(NamedTuple):
    """What to compute over a column: ``rows``, ``present``, ``strict`` or ``lenient``."""

    kind: str
    column: str | None = None


def measure_rows() -> Measure:
    return Measure("rows")


def measure_present(column: str) -> Measure:
    return Measure("present", column)


def complete_sum(column: str) -> Measure:
    """Sum that is NULL if any value is missing."""
    return Measure("strict", column)


def lenient_sum(column: str) -> Measure:
    """Sum that skips missing values and is 0 for none."""
    return Measure("lenient", column)


Measures = Mapping[str, Measure]


def _direct(m: Measure) -> Column:
    if m.kind == "rows":
        return n_rows()
    col = F.col(m.column)
    return {"present": count_present, "strict": sum_strict, "lenient": sum_lenient}[m.kind](col)


def _partials(measures: Measures) -> list[Column]:
    out = [n_rows().alias("__rows")]
    for name, m in measures.items():
        if m.kind in ("present", "strict"):
            out.append(F.count(m.column).alias(f"__present_{name}"))
        if m.kind in ("strict", "lenient"):
            out.append(F.sum(m.column).alias(f"__sum_{name}"))
    return out


def _merged(name: str, m: Measure, total: Callable[[Column], Column] = F.sum) -> Column:
    if m.kind == "rows":
        return total(F.col("__rows"))
    if m.kind == "present":
        return total(F.col(f"__present_{name}"))
    value = total(F.col(f"__sum_{name}"))
    if m.kind == "lenient":
        return F.coalesce(value, F.lit(0))
    return F.when(total(F.col(f"__present_{name}")) == total(F.col("__rows")), value)


def summarise(df: DataFrame, by: Sequence[str], measures: Measures) -> DataFrame:
    """One row per group; a missing key is a group."""
    return df.groupBy(*by).agg(*[_direct(m).alias(name) for name, m in measures.items()])


def summarise_through(
    df: DataFrame,
    first_by: Sequence[str],
    relabel: Callable[[DataFrame], DataFrame],
    by: Sequence[str],
    measures: Measures,
) -> DataFrame:
    """Summarise by the raw keys, relabel the groups (say by a join), summarise again.

    The same result as relabelling every row first, but the join sees one row per raw key
    instead of all rows: a key that holds a third of the input is one row when it is joined.
    """
    partial = df.groupBy(*first_by).agg(*_partials(measures))
    return (
        relabel(partial)
        .groupBy(*by)
        .agg(*[_merged(name, m).alias(name) for name, m in measures.items()])
    )


def group_constant(
    df: DataFrame,
    by: Sequence[str],
    constants: Sequence[str],
    measures: Measures,
    mode: str = "assert",
) -> DataFrame:
    """Measures per group next to columns that do not vary within the group.

    ``assert`` fails on a group with more than one value; ``expand`` gives one row per distinct
    value, each with the measures of the whole group. A missing value counts as a value. The
    rows are combined by group and constants first, so what follows is small.
    """
    if mode not in ("assert", "expand"):
        raise ValueError(f"unknown mode {mode!r}")
    partial = df.groupBy(*by, *constants).agg(*_partials(measures))
    if mode == "expand":
        group = Window.partitionBy(*by)
        return partial.select(
            *by,
            *[
                _merged(name, m, lambda c: F.sum(c).over(group)).alias(name)
                for name, m in measures.items()
            ],
            *constants,
        )
    grouped = partial.groupBy(*by).agg(
        n_rows().alias("__values"),
        *[_merged(name, m).alias(name) for name, m in measures.items()],
        *[F.first(c).alias(c) for c in constants],
    )
    message = F.concat(
        F.lit(f"more than one value of {', '.join(constants)} in group "),
        F.to_json(F.struct(*by)),
    )
    passed = F.when(F.col("__values") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return grouped.where(passed).drop("__values")
