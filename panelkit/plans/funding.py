"""Money asked for and received, per country and year, without gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import lenient_sum, summarise
from ..operators.bind import bind_rows, distinct_rows, harmonise
from ..operators.complete import complete

MONEY = "decimal(38,6)"
"""Amounts are added exactly to a millionth, up to 10**32."""


def funding_panel(
    files: DataFrame | Sequence[DataFrame | None],
    start: int = 2000,
    stop: int = 2022,
    entity: str = "countryCode",
    year: str = "year",
    amounts: Sequence[str] = ("requirements", "funding"),
    casts: Mapping[str, str] | None = None,
    money: str = MONEY,
) -> DataFrame:
    """(iso3, year, *amounts): stacked files, copies dropped, summed, gaps filled with 0.

    Amounts are added as ``money``, so the sums do not depend on the order of the rows, and are
    returned as doubles. Whole-row copies collapse within each task before the shuffle.
    """
    tables = [files] if isinstance(files, DataFrame) else files
    rows = distinct_rows(bind_rows(*harmonise(tables, casts or {"typeName": "string"})))
    rows = rows.select(
        F.col(entity).alias("iso3"),
        F.col(year).cast("int").alias("year"),
        *[F.col(c).cast(money).alias(c) for c in amounts],
    )
    sums = summarise(rows, ["iso3", "year"], {c: lenient_sum(c) for c in amounts})
    sums = sums.withColumns({c: F.col(c).cast("double") for c in amounts})
    return complete(
        sums, ["iso3"], "year", start, stop, fill={c: 0 for c in amounts}, summarised=True
    )
