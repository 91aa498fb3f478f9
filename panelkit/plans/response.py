"""Which countries have a response plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import any3
from ..operators.columns import transmute
from ..operators.recode import recode_names


def plan_flags(
    plans: DataFrame,
    names: DataFrame | None = None,
    patterns: Sequence[tuple[str, str]] = (),
    overrides: Mapping[str, str] | None = None,
    plan: str = "Plans",
    plan_type: str = "Plan type",
    kinds: tuple[str, str] = ("HRP", "RRP"),
) -> DataFrame:
    """(iso3, hrp, rrp, hrp_rrp, plan): three-valued ANY over the plans of a country."""
    coded = recode_names(plans, plan, "iso3", names, patterns, overrides)
    flags = transmute(
        coded,
        {
            "hrp": F.col(f"`{plan_type}`") == kinds[0],
            "rrp": F.col(f"`{plan_type}`") == kinds[1],
        },
        {"hrp_rrp": F.col("hrp") | F.col("rrp"), "plan": F.lit(True)},
        keep=["iso3"],
    )
    return flags.groupBy("iso3").agg(
        *[any3(F.col(c)).alias(c) for c in flags.columns if c != "iso3"]
    )
