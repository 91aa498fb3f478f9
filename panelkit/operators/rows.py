"""Row order and leading rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import fits_in_broadcast, settle


def arrange(df: DataFrame, *names: str) -> DataFrame:
    """Sort ascending with missing values last. Use it right before a sink."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in names])


def first_rows(df: DataFrame, k: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first ``k`` rows of each group.

    For a ``k`` up to 1000 (the default of ``spark.sql.optimizer.windowGroupLimitThreshold``)
    Spark keeps at most ``k`` rows per group and task before it shuffles them, so a group of any
    size is never sorted in one task; beyond it, it is.
    """
    rank = F.row_number().over(
        Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    )
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def drop_first_rows(df: DataFrame, k: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop the first ``k`` rows of each group; ``order`` must number the rows of a group.

    Only the keys of the leading rows are ranked. They are written once and taken out by an
    anti join on group and order together, which no large group can unbalance. While they are
    few, as for files, they are broadcast and the rows themselves are not shuffled at all.
    """
    keys = list(by) + list(order)
    head = first_rows(df.select(*keys), k, by, order)
    head = settle(head.select(*[F.col(c).alias(f"__head_{c}") for c in keys]))
    texts = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in head.columns]
    if fits_in_broadcast(head, sum(texts, F.lit(64))):
        head = F.broadcast(head)
    on = [df[c].eqNullSafe(head[f"__head_{c}"]) for c in keys]
    return df.join(head, on, "left_anti")
