"""Years and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_in_year(year: Column, month: int = 6, day: int = 1) -> Column:
    """The given day of a year column, by default 1 June."""
    return F.make_date(year.cast("int"), F.lit(month), F.lit(day))


def year_between(date: Column, first: int, last: int) -> Column:
    """Is the year of a date or time in first..last? Written on the column itself, so that the
    file reader can skip what is out of range."""
    return (date >= F.lit(dt.date(first, 1, 1))) & (date < F.lit(dt.date(last + 1, 1, 1)))
