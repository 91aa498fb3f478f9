"""Left joins in which missing keys match, and the check of dimension keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import n_rows

FINER = 4
"""Shares of a heavy key per task's share, so that chance does not put many into one task."""


def left_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    suffixes: tuple[str, str] = ("_x", "_y"),
    spread: bool = False,
) -> DataFrame:
    """Left join on equal names; two missing keys match; duplicate right keys fan out.

    It stays a hash or sort-merge join. All rows with the same key, or with a missing one, meet
    in one partition; that is right for summarised tables and small right sides. For raw rows
    and a large right side set ``spread``: keys that hold more than a task's share of the left
    rows are found first and dealt out, with copies of their right rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    clash = [c for c in right.columns if c in left.columns and c not in by]
    for c in clash:
        left = left.withColumnRenamed(c, c + suffixes[0])
        right = right.withColumnRenamed(c, c + suffixes[1])
    payload = [c for c in right.columns if c not in by]
    keys = {c: f"__right_{c}" for c in by}
    right = right.select(*[F.col(c).alias(k) for c, k in keys.items()], *payload)
    names = left.columns
    if spread:
        left, right = _dealt_out(left, by, right, list(keys.values()))
    on = [left[c].eqNullSafe(right[k]) for c, k in keys.items()]
    if spread:
        on.append(left["__share"] == right["__right_share"])
    return left.join(right, on, "left").select(*[left[c] for c in names], *payload)


def heavy_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(__heavy, __shares): hashes of the keys with more rows than a task's share, and their shares.

    A sketch of bounded size (as many counters as there are tasks, per task) holds every key
    that can be so frequent; then these few are counted. A missing key is a key like others.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashes = df.select(F.xxhash64(*by).alias("__heavy"))
    often = hashes.freqItems(["__heavy"], max(1e-4, 1 / tasks)).first()[0]
    counted = (
        hashes.groupBy(F.when(F.col("__heavy").isin(often), F.col("__heavy")).alias("__heavy"))
        .agg(n_rows().alias("n"))
        .collect()
    )
    total = max(sum(r["n"] for r in counted), 1)
    frequent = [r for r in counted if r["__heavy"] is not None and r["n"] * tasks > total]
    # fewer rows than tasks
    return df.sparkSession.createDataFrame(
        [(r["__heavy"], -(-FINER * r["n"] * tasks // total)) for r in frequent],
        "__heavy long, __shares long",
    )


def _dealt_out(
    left: DataFrame, left_by: Sequence[str], right: DataFrame, right_by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a share: heavy left rows get one of their key's, right rows get all."""
    heavy = F.broadcast(heavy_keys(left, left_by))
    shares = F.coalesce("__shares", F.lit(1))
    # the partition number parts even identical rows, and is the same when a task is rerun
    hashable = [name for name, kind in left.dtypes if "map<" not in kind]
    own = F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), shares)
    left = left.withColumn("__key", F.xxhash64(*left_by))
    left = left.join(heavy, left["__key"] == heavy["__heavy"], "left")
    left = left.withColumn("__share", own).drop("__key", "__heavy", "__shares")
    right = right.withColumn("__key", F.xxhash64(*right_by))
    right = right.join(heavy, right["__key"] == heavy["__heavy"], "left")
    right = right.withColumn("__right_share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)))
    return left, right.drop("__key", "__heavy", "__shares")


def require_unique(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """The same rows, but a key that occurs twice makes the query fail.

    The check is a grouping inside the plan, so it costs one shuffle of the dimension and no
    separate job.
    """
    by = [by] if isinstance(by, str) else list(by)
    payload = [c for c in df.columns if c not in by]
    grouped = df.groupBy(*by).agg(
        n_rows().alias("__n"), *[F.first(c).alias(c) for c in payload]
    )
    message = F.concat(F.lit(f"duplicate key in {', '.join(by)}: "), F.to_json(F.struct(*by)))
    # the check is a filter, which no projection or count can prune
    passed = F.when(F.col("__n") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return grouped.where(passed).select(*df.columns)
