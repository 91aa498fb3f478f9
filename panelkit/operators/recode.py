"""Replacing codes and names through dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import if_else
from ..functions.text import matches_any, name_key
from .staging import fits_in_broadcast, settle

GRAM = 3
FEW_PATTERNS = 32
"""So many patterns are tried on every row; more are indexed."""


def lookup_table(
    spark: SparkSession, pairs: Mapping[object, object], key: str, value: str
) -> DataFrame:
    """A dictionary written in the program as a table of two columns.

    It is made of literals, so Spark knows how small it is and broadcasts it unasked.
    """
    rows = [F.struct(F.lit(k).alias(key), F.lit(v).alias(value)) for k, v in pairs.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def recode(
    df: DataFrame,
    source: str,
    dictionary: DataFrame,
    into: str,
    overrides: Mapping[object, object] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``into``: the dictionary's value for ``source``, after fixed overrides.

    ``dictionary`` has the key in its first column and the value in its second. A key that is
    missing, unknown or ambiguous gives NULL, so the row count never changes. Whether the
    dictionary is broadcast is left to Spark, which knows its size.

    Set ``unique`` if the keys are known to be unique, as in a table of customers. A large
    dictionary is then joined as it is stored, which lets adaptive execution split the
    partition of a very frequent key; grouping it first would prevent that. A small job over
    the dictionary's keys checks the promise first.
    """
    key, value = dictionary.columns[:2]
    if unique:
        repeated = dictionary.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"keys of {key!r} repeat; leave unique off")
        entries = dictionary.select(F.col(key).alias("__key"), F.col(value).alias("__code"))
    else:
        low_high = dictionary.groupBy(F.col(key).alias("__key")).agg(
            F.min(value).alias("__low"), F.max(value).alias("__high")
        )
        code = F.when(F.col("__low") == F.col("__high"), F.col("__low"))
        entries = low_high.select("__key", code.alias("__code"))
    found: Column = entries["__code"]
    for code, fixed in (overrides or {}).items():
        found = if_else(df[source] == F.lit(code), F.lit(fixed), found)
    others = [df[c] for c in df.columns if c != into]
    return df.join(entries, df[source] == entries["__key"], "left").select(
        *others, found.alias(into)
    )


def code_by_pattern(name: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Code whose pattern occurs in the name; NULL if none does or several codes do."""
    hits = F.array_distinct(
        F.array_compact(
            F.array(*[F.when(matches_any(name, [p]), F.lit(code)) for p, code in patterns])
        )
    )
    return F.when(F.size(hits) == 1, hits[0])


def required_grams(pattern: str) -> list[str] | None:
    """Texts of which a name must hold one to match the pattern, or None if that is not plain.

    Of each alternative the longest run of ordinary characters outside groups and sets is taken;
    a character that may be absent ends its run. Runs shorter than GRAM tell too little.
    """
    if "(?" in pattern:
        return None
    runs, best, run, depth, n = [], "", "", 0, 0
    while n < len(pattern):
        c, step, plain = pattern[n], 1, ""
        if c == "\\" and n + 1 < len(pattern):
            step = 2
            if pattern[n + 1] in "Qx0cupPkN" or pattern[n + 1].isdigit():
                return None
            plain = "" if pattern[n + 1].isalnum() else pattern[n + 1]
        elif c == "[":
            end = pattern.find("]", n + 2)
            if end < 0:
                return None
            step = end - n + 1
        elif c == "{":
            end = pattern.find("}", n)
            step = end - n + 1 if end > 0 else 1
            run = run[:-1]
        elif c in "?*":
            run = run[:-1]
        elif c == "+":
            pass
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            best = max(best, run, key=len)
            runs.append(best)
            best = run = ""
            n += 1
            continue
        elif c not in ".^$|":
            plain = c
        if plain and not depth:
            run += plain
        else:
            best, run = max(best, run, key=len), ""
        n += step
    runs.append(max(best, run, key=len))
    return runs if all(len(r) >= GRAM for r in runs) else None


def _grams(text: Column) -> Column:
    """The distinct pieces of GRAM characters of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM))))


def index_patterns(spark: SparkSession, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """(__gram, __pattern, __code): each pattern under a gram that a matching name must hold.

    Of the grams of a required run the one that the fewest patterns have is chosen. Patterns
    without such a run stand under the empty gram, which every name has.
    """
    rows = [
        (number, pattern, code, run)
        for number, (pattern, code) in enumerate(patterns)
        for run in required_grams(pattern) or [""]
    ]
    schema = "__number int, __pattern string, __code string, __run string"
    found = spark.createDataFrame(rows, schema).withColumn("__gram", F.explode(_grams(F.col("__run"))))
    often = found.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = F.min_by("__gram", F.struct("__n", "__gram"))
    return (
        found.join(often, "__gram")
        .groupBy("__number", "__pattern", "__code", "__run")
        .agg(rarest.alias("__gram"))
        .select("__gram", "__pattern", "__code")
        .distinct()
    )


def match_names(names: DataFrame, index: DataFrame) -> DataFrame:
    """(__name, __code) of names that match the patterns of exactly one code.

    A name meets only the patterns that stand under one of its grams; only those are tried.
    """
    grams = F.explode(F.array_union(_grams(F.col("__name")), F.array(F.lit(""))))
    index = settle(index)
    text = F.length("__pattern") + F.length("__code") + 64
    if fits_in_broadcast(index, text):
        index = F.broadcast(index)
    met = names.withColumn("__gram", grams).join(index, "__gram")
    hit = met.where(F.expr("__name RLIKE __pattern"))
    codes = hit.groupBy("__name").agg(F.min("__code").alias("__low"), F.max("__code").alias("__code"))
    return codes.where("__low = __code").drop("__low")


def recode_names(
    df: DataFrame,
    source: str,
    into: str,
    names: DataFrame | None = None,
    patterns: Sequence[tuple[str, str]] = (),
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``into``: a code for a name, by exact name first and by pattern for the rest.

    ``names`` is a (name, code) dictionary compared without regard to case and blanks;
    ``patterns`` are (regex, code) pairs tried on the same lower-case form. ``overrides`` are
    exact names with a fixed code. A missing name has no code.

    Up to FEW_PATTERNS patterns are one expression. More are indexed by a piece of text that
    they require, and each distinct name is tried against the patterns under its own pieces, so
    neither the plan nor the work per name grows with their number.
    """
    plain = name_key(F.col(source))
    if names is not None:
        name, code = names.columns[:2]
        entries = names.select(name_key(F.col(name)).alias("__name"), F.col(code))
        df = recode(df.withColumn("__plain", plain), "__plain", entries, "__exact")
        found = F.col("__exact")
    else:
        found = F.lit(None).cast("string")
    if len(patterns) > FEW_PATTERNS:
        distinct = df.select(plain.alias("__name")).where("__name IS NOT NULL").distinct()
        # settled, so that adaptive execution can split the partition of a very frequent name
        codes = settle(match_names(distinct, index_patterns(df.sparkSession, patterns)))
        df = df.withColumn("__plain", plain).join(codes, F.col("__plain") == F.col("__name"), "left")
        found = F.coalesce(found, F.col("__code"))
    elif patterns:
        found = F.coalesce(found, code_by_pattern(plain, patterns))
    for fixed_name, fixed in (overrides or {}).items():
        found = if_else(F.col(source) != F.lit(fixed_name), found, F.lit(fixed))
    return df.withColumn(into, found).drop("__plain", "__exact", "__name", "__code")
