"""Choosing files from a catalogue table (dataset, position, name, path)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .delimited import read_drifting_csv


def first_datasets(
    catalogue: DataFrame,
    rows: int | None = None,
    dataset: str = "dataset",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The files of the first ``rows`` datasets, as a search with a result limit would return.

    ``order`` ranks the datasets (by name if not given). Without ``rows`` all are returned.
    """
    if rows is None:
        return catalogue
    order = list(order or [dataset])
    top = (
        catalogue.groupBy(F.col(dataset).alias("__dataset"))
        .agg(*[F.min(c).alias(f"__order_{i}") for i, c in enumerate(order)])
        .orderBy(*[f"__order_{i}" for i in range(len(order))], "__dataset")
        .limit(rows)
    )
    return catalogue.join(top, catalogue[dataset] == top["__dataset"], "left_semi")


def pick_files(
    catalogue: DataFrame,
    pattern: str | None = None,
    nth: int = 1,
    dataset: str = "dataset",
    position: str = "position",
    name: str = "name",
) -> DataFrame:
    """In each dataset the ``nth`` file, by position, of those whose name matches the regex.

    Datasets with fewer matches give nothing. For an ``nth`` up to 1000 (the default of
    ``spark.sql.optimizer.windowGroupLimitThreshold``) Spark prunes the ranking to that many
    rows per dataset and task before the shuffle; beyond it a task sorts all files of a dataset.
    """
    files = catalogue if pattern is None else catalogue.where(F.col(name).rlike(pattern))
    rank = F.row_number().over(Window.partitionBy(dataset).orderBy(position))
    return files.withColumn("__rank", rank).where(F.col("__rank") == nth).drop("__rank")


def picked_paths(picked: DataFrame, rows: int | None = None, path: str = "path") -> list[str]:
    """Paths of the picked files; more than ``rows`` of them, if given, are an error."""
    paths = picked.select(path)
    paths = paths if rows is None else paths.limit(rows + 1)
    found = sorted(r[0] for r in paths.collect())
    if rows is not None and len(found) > rows:
        raise ValueError(f"more than {rows} files; raise the limit or use first_datasets")
    return found


def read_first_matches(
    spark: SparkSession,
    catalogue: DataFrame,
    pattern: str,
    casts: Mapping[str, str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """The first matching file of each dataset (of the first ``rows``, if given), stacked by name.

    Files that are absent or cannot be decoded to their end are left out whole, with a warning;
    a read that fails for another reason is an error. ``list_files`` makes a catalogue of folders.
    """
    picked = pick_files(first_datasets(catalogue, rows), pattern)
    return read_drifting_csv(spark, picked_paths(picked, rows), casts)
