"""Lines of text files in their order, however Spark splits the files over tasks.

A reader gives rows of (path, block, row): a block is one of Spark's splits of the file, and row
grows within it. What depends on all earlier rows of a file (a line number, the depth of nested
braces) is a running sum: per block first, then over the few blocks of a file, then inside a
block. No task sees more of a file than one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..operators.staging import fits_in_broadcast, settle

BLOCK = ["path", "block"]


def rows_so_far() -> WindowSpec:
    """The rows of a block up to the current one."""
    return Window.partitionBy(*BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)


def rows_before() -> WindowSpec:
    return Window.partitionBy(*BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)


def blocks_before() -> WindowSpec:
    """The blocks of a file before the current one, in a table with a row per block."""
    return Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def file_lines(
    spark: SparkSession, paths: str | Sequence[str], separator: str | None = None
) -> DataFrame:
    """(path, block, row, value): the lines of text files, or what stands between separators.

    They are written once. How files are split depends on the executors that are there, so two
    reads of the same files need not agree on it.
    """
    reader = spark.read.option("ignoreCorruptFiles", False)
    if separator is not None:
        reader = reader.option("lineSep", separator)
    lines = reader.text(paths if isinstance(paths, str) else list(paths))
    return settle(
        lines.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            "value",
        )
    )


def with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows with the columns of their block; the blocks are written, measured and joined."""
    blocks = settle(blocks)
    if fits_in_broadcast(blocks, F.length("path") + 64):
        blocks = F.broadcast(blocks)
    return rows.join(blocks, BLOCK)


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``, the number of a line in its file from 0 on. The lines are not shuffled."""
    blocks = lines.groupBy(*BLOCK).agg(
        F.min("row").alias("__first"), F.count(F.lit(1)).alias("__lines")
    )
    blocks = blocks.withColumn(
        "__before", F.coalesce(F.sum("__lines").over(blocks_before()), F.lit(0))
    )
    line = F.col("__before") + F.col("row") - F.col("__first")
    return with_blocks(lines, blocks).select(*lines.columns, line.alias("line"))
