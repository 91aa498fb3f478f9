"""The composed jobs. Each takes DataFrames and returns one; the spatial ones settle
their tiles and measure them while the plan is built, the others run nothing until a sink."""

from .areas import area_need, enrich_polygons, events_by_area, percent_in_need
from .combined import combined_panel
from .conflict import carve_out, conflict_panel
from .funding import funding_panel
from .reporting import financial_flows, severity_against_events, severity_against_fatalities
from .response import plan_flags
from .severity import OTHER_SHOCKS, crisis_classes

__all__ = [
    "OTHER_SHOCKS", "area_need", "carve_out", "combined_panel", "conflict_panel",
    "crisis_classes", "enrich_polygons", "events_by_area", "financial_flows",
    "funding_panel", "percent_in_need", "plan_flags", "severity_against_events",
    "severity_against_fatalities",
]
