"""Kind and severity of the crisis in a country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_number
from ..functions.text import first_case, matches_any
from ..operators.columns import transmute

# The terms that mark conflict, and those that mark another shock. They are
# matched as they are spelt in the source, including 'Tecnological'.
CONFLICT_TERMS = ("Conflict", "Violence")
OTHER_SHOCKS = (
    "Drought",
    "Earthquake",
    "Socio-political",
    "Floods",
    "Other seasonal event",
    "Cyclone",
    "Tecnological Disaster",
    "Food Security",
    "Epidemic",
)


def crisis_classes(
    df: DataFrame,
    entity: str = "ISO3",
    drivers: str = "DRIVERS",
    severity: str = "INFORM Severity Index",
    pin: str = "People in need",
    conflict_terms: Sequence[str] = CONFLICT_TERMS,
    other_terms: Sequence[str] = OTHER_SHOCKS,
) -> DataFrame:
    """Flags and class from free text, and two figures read leniently. No shuffle.

    Both kinds of driver make a crisis Complex, one of them Conflict or Other, none leaves the
    class NULL. Missing text leaves all of it NULL.
    """
    return transmute(
        df,
        {
            "iso3": F.col(entity),
            "conflict_crisis": matches_any(F.col(drivers), conflict_terms),
            "other_crisis": matches_any(F.col(drivers), other_terms),
        },
        {"complex_crisis": F.col("conflict_crisis") & F.col("other_crisis")},
        {
            "inform_class": first_case(
                [
                    (F.col("complex_crisis"), "Complex"),
                    (F.col("conflict_crisis"), "Conflict"),
                    (F.col("other_crisis"), "Other"),
                ]
            ),
            "inform_severity": to_number(F.col(f"`{severity}`")),
            "inform_pin": to_number(F.col(f"`{pin}`")),
        },
    )
