"""Queries over the driver's tables, each next to the SQL that gives the same rows.

The analogy: nations are countries (those of region 4 have no code, so there are missing keys),
order and ship dates give years, prices are money or fatality estimates, line items are
incidents with coordinates made of price and discount.
"""

from . import geo, grids, ingest, jobs, shaping, windows
from .common import Query

REGISTRY: dict[str, Query] = {}
for _module in (ingest, shaping, grids, windows, geo, jobs):
    REGISTRY.update(_module.QUERIES)
