"""Plot-ready tables from the combined panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import is_present
from ..functions.numbers import log10, number_label
from ..operators.aggregate import complete_sum, group_constant, lenient_sum, summarise
from ..operators.deflate import deflate
from ..operators.shares import add_share, add_stack
from .funding import MONEY

AMOUNTS = ("funding", "requirements")


def financial_flows(
    panel: DataFrame,
    rates: DataFrame,
    start: int = 2015,
    stop: int = 2022,
    price_year: int = 2021,
    stacked: str = "funding_real",
    money: str = MONEY,
) -> DataFrame:
    """Money per year and crisis class: totals, shares of the year, real value, area bounds.

    ``rates`` is (year, rate) with inflation in percent. After the grouping there is one row
    per year and class, so the windows work on a handful of rows.
    """
    rows = panel.where(F.col("year").between(start, stop) & is_present(F.col("inform_class")))
    rows = rows.select(
        "year", "inform_class", *[F.col(c).cast(money).alias(c) for c in AMOUNTS]
    )
    totals = summarise(rows, ["year", "inform_class"], {c: complete_sum(c) for c in AMOUNTS})
    totals = add_share(totals, ["year"], {f"{c}_pct": c for c in AMOUNTS})
    totals = totals.withColumns({c: F.col(c).cast("double") for c in AMOUNTS})
    real = deflate(totals, "year", {f"{c}_real": c for c in AMOUNTS}, rates, price_year)
    return add_stack(real, ["year"], "inform_class", stacked).withColumn(
        "label", number_label(F.col(stacked), 1e-9, "$", "B")
    )


def severity_against_fatalities(
    panel: DataFrame,
    since: int = 2013,
    to_year: int | None = None,
    mode: str = "assert",
) -> DataFrame:
    """Per country: fatalities of the period, their log, severity and plan flag.

    ``mode`` says what happens if severity or flag vary within a country: fail, or one row per
    value.
    """
    rows = panel.where(F.col("year") >= since)
    if to_year is not None:
        rows = rows.where(F.col("year") <= to_year)
    grouped = group_constant(
        rows,
        ["iso3"],
        ["inform_severity", "hrp_rrp"],
        {"fatalities": lenient_sum("fatalities")},
        mode,
    )
    return grouped.where(is_present(F.col("inform_severity"))).select(
        "iso3",
        "fatalities",
        log10(F.col("fatalities")).alias("fatalities_log10"),
        "inform_severity",
        "hrp_rrp",
    )


def severity_against_events(
    panel: DataFrame,
    severity: str = "inform_severity",
    displacement: str = "inform_displacement",
    events: str = "events",
    mode: str = "assert",
) -> DataFrame:
    """Per country: number of events next to its severity and its displacement severity."""
    return group_constant(
        panel, ["iso3"], [severity, displacement], {events: lenient_sum(events)}, mode
    ).where(is_present(F.col(severity)))
