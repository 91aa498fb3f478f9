"""Shares of a group total and stacked bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import share


def add_share(df: DataFrame, within: Sequence[str], parts: Mapping[str, str]) -> DataFrame:
    """Add ``parts[new] / its total within the group`` for each new column.

    Meant for summarised tables, in which a group has one row per class: the window then holds
    a handful of rows.
    """
    group = Window.partitionBy(*within)
    return df.withColumns(
        {new: share(F.col(c), F.sum(c).over(group)) for new, c in parts.items()}
    )


def add_stack(
    df: DataFrame,
    within: Sequence[str],
    layer: str,
    height: str,
    bounds: tuple[str, str] = ("ymin", "ymax"),
) -> DataFrame:
    """Lower and upper bound of each layer when layers are stacked, the last one at the bottom.

    Meant for summarised tables, with one row per layer within a group.
    """
    downwards = Window.partitionBy(*within).orderBy(F.col(layer).desc_nulls_first())
    below = downwards.rowsBetween(Window.unboundedPreceding, -1)
    upto = downwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high = bounds
    return df.withColumns(
        {
            low: F.coalesce(F.sum(height).over(below), F.lit(0)),
            high: F.sum(height).over(upto),
        }
    )
