"""Types for text columns, guessed from all of their values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import DECIMAL_TEXT

# What counts as missing, and the texts each type accepts. A number with a
# leading zero is a code and stays text. Spark alone would also take '1.5d' or '2020'.
MISSING_TEXTS = ("", "NA")
BOOLEAN_TEXTS = ("T", "F", "TRUE", "FALSE", "true", "false")
DATE_TEXT = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
CLOCK = r"([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.][0-9]+)?)?"
MOMENT_TEXT = rf"^[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}[ T]{CLOCK}Z?$"

TIME = "interval day to second"
# A bit for each type, in the order in which they are preferred; text is none of them.
BITS = {"boolean": 1, "bigint": 2, "double": 4, TIME: 8, "date": 16, "timestamp_ntz": 32}


def _text(col: Column, na: Sequence[str]) -> Column:
    trimmed = F.trim(col)
    return F.when(~trimmed.isin(list(na)), trimmed)


def _value(text: Column, kind: str) -> Column:
    """A text as a type that it can be read as."""
    if kind == "boolean":
        return F.upper(text).isin("T", "TRUE")
    if kind == TIME:
        parts = F.split(text, ":")
        second = F.coalesce(F.try_element_at(parts, F.lit(3)).try_cast("decimal(18,6)"), F.lit(0))
        hour, minute = (F.try_element_at(parts, F.lit(n)).try_cast("int") for n in (1, 2))
        return F.make_dt_interval(F.lit(0), hour, minute, second)
    if kind in ("date", "timestamp_ntz"):
        return F.translate(text, "/", "-").try_cast(kind)
    return text.try_cast(kind)


def _mask(text: Column) -> Column:
    """The types that a text can be read as, a bit for each; NULL for a missing text.

    The first characters decide which one test is made, so plain words cost a comparison. A
    date is also a moment, at midnight.
    """

    def bits(*kinds: str) -> Column:
        return F.lit(sum(BITS[k] for k in kinds))

    first = F.substring(text, 1, 1)
    body = F.when(first.isin("+", "-"), F.substring(text, 2, 2)).otherwise(F.substring(text, 1, 2))
    dated = F.substring(text, 5, 1).isin("-", "/") & F.substring(text, 4, 1).between("0", "9")
    clock = (F.substring(text, 2, 1) == ":") | (F.substring(text, 3, 1) == ":")
    whole = ~(text.contains(".") | text.contains("e") | text.contains("E"))
    day = F.when(
        text.rlike(DATE_TEXT) & _value(text, "date").isNotNull(), bits("date", "timestamp_ntz")
    ).otherwise(0)
    moment = F.when(
        text.rlike(MOMENT_TEXT) & _value(text, "timestamp_ntz").isNotNull(), bits("timestamp_ntz")
    ).otherwise(0)
    number = (
        F.when(body.between("00", "09") | ~text.rlike(DECIMAL_TEXT), 0)
        .when(whole & text.try_cast("bigint").isNotNull(), bits("bigint", "double"))
        .otherwise(bits("double"))
    )
    numeric = (
        F.when(dated, F.when(F.length(text) <= 10, day).otherwise(moment))
        .when(clock, F.when(text.rlike(f"^{CLOCK}$"), bits(TIME)).otherwise(0))
        .otherwise(number)
    )
    return (
        F.when(first.between("+", "9"), numeric)
        .when(text.isin(*BOOLEAN_TEXTS), bits("boolean"))
        .when(text.isNotNull(), 0)
    )


def guess_types(
    df: DataFrame,
    names: Iterable[str] | None = None,
    na: Sequence[str] = MISSING_TEXTS,
    guess_integer: bool = False,
) -> dict[str, str]:
    """The first of BITS that every value can be read as, else string.

    Every value becomes one mask of the types it can be, and the masks of a column are combined
    by a bitwise AND: one job over all rows and columns, which returns a number per column.
    Whole numbers are doubles unless ``guess_integer``; dates among moments are moments. A
    column without values is boolean.
    """
    names = list(names) if names is not None else [n for n, t in df.dtypes if t == "string"]
    if not names:
        return {}
    masks = [
        F.bit_and(_mask(_text(F.col(name), na))).alias(f"mask_{i}") for i, name in enumerate(names)
    ]
    found = df.agg(*masks).first()
    kinds = [k for k in BITS if guess_integer or k != "bigint"]
    everything = sum(BITS.values())
    out = {}
    for name, mask in zip(names, found):
        mask = everything if mask is None else mask
        out[name] = next((k for k in kinds if mask & BITS[k]), "string")
    return out


def retype(
    df: DataFrame,
    types: dict[str, str] | None = None,
    na: Sequence[str] = MISSING_TEXTS,
    guess_integer: bool = False,
) -> DataFrame:
    """Cast text columns to the given types, or to the guessed ones if none are given.

    A guessed type fits every value, so nothing is tested again. Where types are given, a value
    that its mask does not allow becomes NULL. Times of day are intervals from midnight.
    """
    guessed = types is None
    if types is None:
        types = guess_types(df, na=na, guess_integer=guess_integer)
    changed = {}
    for name, kind in types.items():
        text = _text(F.col(name), na)
        if kind not in BITS:
            changed[name] = text
        elif guessed:
            changed[name] = _value(text, kind)
        else:
            allowed = _mask(text).bitwiseAND(F.lit(BITS[kind])) != 0
            changed[name] = F.when(allowed, _value(text, kind))
    return df.withColumns(changed) if changed else df
