"""Number parsing, safe ratios, logarithms and axis labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts read as a decimal number or as infinity. Spark alone would also take
# Java literals such as '1.5d' or '0x1p3'.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE_TEXT = r"^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"


def to_number(col: Column) -> Column:
    """Text to double; whatever is not a number becomes NULL instead of an error."""
    text = col.cast("string")
    below = F.trim(text).startswith("-")
    infinite = F.when(below, float("-inf")).otherwise(float("inf"))
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double")).when(
        text.rlike(INFINITE_TEXT), infinite
    )


def log10(col: Column) -> Column:
    """log10 that is -Infinity at 0 and NaN below it (Spark alone gives NULL)."""
    x = col.cast("double")
    return (
        F.when(x == 0, F.lit(float("-inf")))
        .when(x < 0, F.lit(float("nan")))
        .otherwise(F.log10(x))
    )


def share(part: Column, total: Column) -> Column:
    """part / total as double; NULL when the total is 0 (not NaN or Infinity)."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def comma_label(col: Column, digits: int = 0) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(col.cast("double"), digits)


def number_label(
    col: Column, scale: float = 1.0, prefix: str = "", suffix: str = "", digits: int = 0
) -> Column:
    """Scaled number between a prefix and a suffix, e.g. '$3B' for 3.1e9 at scale 1e-9."""
    x = col.cast("double") * F.lit(float(scale))
    body = F.concat(F.lit(prefix), F.format_number(F.abs(x), digits), F.lit(suffix))
    return F.when(x < 0, F.concat(F.lit("-"), body)).otherwise(body)
