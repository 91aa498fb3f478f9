"""Gap-free grids: every entity with every value of a range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def complete(
    df: DataFrame,
    by: Sequence[str],
    over: str,
    start: int | dt.date,
    stop: int | dt.date,
    fill: Mapping[str, object] | None = None,
    keys: DataFrame | None = None,
    constants: Mapping[str, object] | None = None,
    summarised: bool = False,
) -> DataFrame:
    """Add a row for each (entity, value) of the grid that has none, then fill defaults.

    ``by``         entity columns; a missing entity is an entity. Empty: only ``over`` is a key
    ``over``       integer or date column, completed from ``start`` to ``stop`` inclusive
    ``fill``       defaults for new rows *and* for missing values that were there before
    ``keys``       more entities (same ``by`` columns) that must be in the grid
    ``constants``  values of other columns in the new rows; without one they are NULL
    ``summarised`` the rows are unique per entity and value, as after a grouping

    Rows outside the grid stay. There are two ways to the same result. Summarised rows go
    through one window per entity, in which each row adds the gap that follows the row before
    it, so the input is computed once. Any other input is reduced to the set of values seen
    per entity (never larger than the grid), the rest of the grid is added by a union, and the
    rows themselves are not shuffled at all, however skewed they are.
    """
    by = list(by)
    kind = df.schema[over].dataType
    if summarised and by:
        filled = _through_window(df, by, over, kind, start, stop, keys)
    elif summarised:
        filled = _around_grid(df, over, kind, start, stop)
    else:
        filled = _through_seen(df, by, over, kind, start, stop, keys)
    return _defaults(filled, dict(fill or {}), dict(constants or {})).select(*df.columns)


def _bound(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _span(low: Column, high: Column, kind: T.DataType) -> Column:
    """Array low..high, empty when low is above high."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast(T.ArrayType(kind)))


def _step(col: Column, by: int, kind: T.DataType) -> Column:
    return F.date_add(col, by) if isinstance(kind, T.DateType) else (col + F.lit(by)).cast(kind)


def _through_window(df, by, over, kind, start, stop, keys) -> DataFrame:
    low, high = _bound(start, kind), _bound(stop, kind)
    rows = df.withColumn("__own", F.lit(True))
    if keys is not None:
        extra = keys.select(*by).distinct().withColumn("__own", F.lit(False))
        rows = rows.unionByName(extra, allowMissingColumns=True)
    entity = Window.partitionBy(*by).orderBy(F.col(over).asc_nulls_first())
    rows = rows.withColumns(
        {
            "__before": F.lag(over).over(entity),
            "__last": F.lead(F.lit(1)).over(entity).isNull(),
        }
    )
    here = F.col(over)
    since = F.greatest(low, _step(F.col("__before"), 1, kind))
    ahead = F.when(here.isNotNull(), _span(since, F.least(high, _step(here, -1, kind)), kind))
    beyond = F.when(F.col("__last"), _span(F.greatest(low, _step(here, 1, kind)), high, kind))
    nothing = F.array().cast(T.ArrayType(kind))
    gaps = F.concat(F.coalesce(ahead, nothing), F.coalesce(beyond, nothing))
    # NULL stands for the row itself, the other elements are new rows
    own = F.array(F.lit(None).cast(kind))
    slots = F.when(F.col("__own"), F.concat(own, gaps)).otherwise(gaps)
    new = F.col("__at").isNotNull()
    payload = [c for c in df.columns if c not in by and c != over]
    return rows.withColumn("__at", F.explode(slots)).select(
        *by,
        F.coalesce(F.col("__at"), here).alias(over),
        *[F.when(~new, F.col(c)).alias(c) for c in payload],
        new.alias("__new"),
    )


def _through_seen(df, by, over, kind, start, stop, keys) -> DataFrame:
    low, high = _bound(start, kind), _bound(stop, kind)
    inside = F.when(F.col(over).between(low, high), F.col(over)).alias(over)
    seen = df.select(*by, inside)
    if keys is not None:
        seen = seen.unionByName(keys.select(*by), allowMissingColumns=True)
    # the distinct pairs are found by hashing, map side first; a set gathered straight from the
    # rows would fall back to sorting them where there are many entities
    gaps = (
        seen.distinct()
        .groupBy(*by)
        .agg(F.collect_list(over).alias("__seen"))
        .select(
            *by,
            F.explode(F.array_except(F.sequence(low, high), F.col("__seen"))).alias(over),
            F.lit(True).alias("__new"),
        )
    )
    return df.withColumn("__new", F.lit(False)).unionByName(gaps, allowMissingColumns=True)


def _around_grid(df, over, kind, start, stop) -> DataFrame:
    grid = df.sparkSession.range(1).select(
        F.explode(F.sequence(_bound(start, kind), _bound(stop, kind))).alias("__at")
    )
    rows = df.withColumn("__new", F.lit(False))
    return rows.join(grid, rows[over] == grid["__at"], "full_outer").select(
        *[
            F.coalesce(F.col(c), F.col("__at")).alias(c) if c == over else F.col(c)
            for c in df.columns
        ],
        F.coalesce(F.col("__new"), F.lit(True)).alias("__new"),
    )


def _defaults(df, fill, constants) -> DataFrame:
    types = dict(df.dtypes)
    changed = {
        c: F.when(F.col("__new"), F.lit(v).cast(types[c])).otherwise(F.col(c))
        for c, v in constants.items()
    }
    if changed:
        df = df.withColumns(changed)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in fill.items()}
    ) if fill else df
