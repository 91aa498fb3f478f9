"""Prices of one year in money of another."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import same
from ..functions.numbers import share
from .joins import require_unique


def price_index(rates: DataFrame, year: str = "year", rate: str = "rate") -> DataFrame:
    """Chained index (year, chain, price_level) from yearly inflation in percent.

    Years without a rate break the chain: ``chain`` numbers the unbroken stretches, and levels
    compare only within one. The table has one row per calendar year, a few thousand at most
    (years 1 to 9999, or the query fails; checked to be unique), so a single window over it is
    safe.
    """
    message = F.concat(F.lit("no calendar year: "), F.coalesce(F.col(year).cast("string"), F.lit("NULL")))
    calendar = F.when(F.col(year).between(1, 9999), True).otherwise(
        F.raise_error(message).cast("boolean")
    )
    known = require_unique(
        rates.where(F.col(rate).isNotNull()).where(calendar).select(
            F.col(year).cast("int").alias("year"), F.col(rate).cast("double").alias("__rate")
        ),
        "year",
    )
    # a constant partition, as the whole table is one series
    series = Window.partitionBy(F.lit(0)).orderBy("year")
    running = Window.partitionBy("chain").orderBy("year")
    return (
        known.withColumn("chain", F.col("year") - F.row_number().over(series))
        .withColumn(
            "price_level",
            F.exp(F.sum(F.log(1 + F.col("__rate") / 100)).over(running)),
        )
        .select("year", "chain", "price_level")
    )


def deflate(
    df: DataFrame,
    year: str,
    amounts: Mapping[str, str],
    rates: DataFrame,
    to_year: int,
) -> DataFrame:
    """Add ``amounts[new]`` in prices of ``to_year`` for each new column.

    NULL if the year of the row or the target year has no rate, or if a year between them has
    none; nothing is extrapolated.
    """
    index = price_index(rates)
    target = index.where(F.col("year") == to_year).select(
        F.col("chain").alias("__chain"), F.col("price_level").alias("__target")
    )
    factors = index.join(target, index["chain"] == target["__chain"]).select(
        F.col("year").alias("__year"),
        share(F.col("__target"), F.col("price_level")).alias("__factor"),
    )
    joined = df.join(F.broadcast(factors), same(df[year].cast("int"), factors["__year"]), "left")
    return joined.withColumns(
        {new: F.col(c).cast("double") * F.col("__factor") for new, c in amounts.items()}
    ).drop("__year", "__factor")
