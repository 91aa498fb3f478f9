"""Column selection by range and suffix, and staged projections."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names of the columns from ``first`` to ``last``, both included."""
    start, stop = df.columns.index(first), df.columns.index(last)
    if start > stop:
        start, stop = stop, start
    return df.columns[start : stop + 1]


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Drop the columns whose name ends with a suffix, in any case."""
    return df.drop(*[c for c in df.columns if c.lower().endswith(suffix.lower())])


def add_in_stages(df: DataFrame, *stages: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite columns; each stage sees the values the stage before it made.

    Spark resolves a name against the input of a projection, so a column that reads a name
    defined beside it would see the old value. One stage per level of dependency fixes that,
    and the optimizer folds the stages back into one projection.
    """
    for stage in stages:
        df = df.withColumns(dict(stage))
    return df


def transmute(df: DataFrame, *stages: Mapping[str, Column], keep: Iterable[str] = ()) -> DataFrame:
    """Like :func:`add_in_stages`, but only ``keep`` and the new columns stay."""
    names = list(keep)
    for stage in stages:
        names += [name for name in stage if name not in names]
    return add_in_stages(df, *stages).select(*names)


def replace_missing(df: DataFrame, names: Iterable[str], value) -> DataFrame:
    """Default for missing values of the named columns; a type that cannot hold it fails."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(types[c])) for c in names}
    )


def apply_to(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """The same column function over several columns."""
    return df.withColumns({c: fn(F.col(c)) for c in names})
