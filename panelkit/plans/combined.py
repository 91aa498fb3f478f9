"""One table per country and year."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.columns import col_range, replace_missing
from ..operators.joins import left_join, require_unique


def combined_panel(
    funding: DataFrame, severity: DataFrame, conflict: DataFrame, plans: DataFrame
) -> DataFrame:
    """Severity, conflict and plans joined to the rows of the funding panel.

    Severity is one snapshot, so every year of a country carries the same one. Missing
    countries match missing countries. The severity key must be unique; the others are group
    keys already. Countries without a plan have FALSE flags.
    """
    df = left_join(funding, require_unique(severity, "iso3"), "iso3")
    df = left_join(df, conflict, ["iso3", "year"])
    df = left_join(df, plans, "iso3")
    return replace_missing(df, col_range(df, "hrp", "plan"), False)
