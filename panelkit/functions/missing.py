"""Conditions and defaults that treat a missing value as a value of its own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(col: Column, values: Iterable) -> Column:
    """Membership that is never NULL: a missing value is a member only if None is listed."""
    values = list(values)
    known = [v for v in values if v is not None]
    hit = F.coalesce(col.isin(known), F.lit(False)) if known else F.lit(False)
    return (hit | col.isNull()) if None in values else hit


def not_in(col: Column, values: Iterable) -> Column:
    """Negated membership that keeps rows whose value is missing."""
    return ~is_in(col, values)


def is_present(col: Column) -> Column:
    return col.isNotNull()


def if_else(condition: Column, yes, no) -> Column:
    """Two-armed choice that is NULL when the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def default(col: Column, value) -> Column:
    return F.coalesce(col, value if isinstance(value, Column) else F.lit(value))


def same(a: Column, b: Column) -> Column:
    """Equality under which two missing values are equal."""
    return a.eqNullSafe(b)
