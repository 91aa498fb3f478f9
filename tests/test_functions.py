"""Missing-value rules, one literal table each."""

import datetime as dt
import math

from pyspark.sql import functions as F

from panelkit import functions as pf


def test_not_in_keeps_missing(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "c string")
    assert rows(df.where(pf.not_in(F.col("c"), ["A", "B"]))) == [("C",), (None,)]
    assert rows(df.where(pf.not_in(F.col("c"), ["A", None]))) == [("B",), ("C",)]
    assert rows(df.where(pf.is_in(F.col("c"), ["A", None]))) == [("A",), (None,)]
    assert df.where(pf.is_in(F.col("c"), [])).count() == 0
    assert df.where(pf.not_in(F.col("c"), [])).count() == 4


def test_if_else_is_null_for_a_null_condition(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    out = df.select(pf.if_else(F.col("c") == 1, F.lit("yes"), F.lit("no"))).collect()
    assert [r[0] for r in out] == ["yes", "no", None]


def test_sums(spark, rows):
    df = spark.createDataFrame(
        [("all", 1.0), ("all", 2.0), ("some", 1.0), ("some", None), ("none", None), (None, 4.0)],
        "g string, x double",
    )
    out = df.groupBy("g").agg(
        pf.n_rows(), pf.count_present(F.col("x")), pf.sum_lenient(F.col("x")),
        pf.sum_strict(F.col("x")),
    )
    assert rows(out) == [
        ("all", 2, 2, 3.0, 3.0),
        ("none", 1, 0, 0.0, None),
        ("some", 2, 1, 1.0, None),
        (None, 1, 1, 4.0, 4.0),
    ]


def test_any3(spark, rows):
    df = spark.createDataFrame(
        [("fn", False), ("fn", None), ("tn", True), ("tn", None), ("ff", False), ("ff", False),
         ("nn", None)],
        "g string, b boolean",
    )
    assert rows(df.groupBy("g").agg(pf.any3(F.col("b")))) == [
        ("ff", False), ("fn", None), ("nn", None), ("tn", True),
    ]


def test_to_number(spark):
    texts = ["x", "", " 1.5 ", "1e3", "1.5d", "0x1p3", "NA", None, "-.5", "7."]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    out = [r[0] for r in df.select(pf.to_number(F.col("t"))).collect()]
    assert out == [None, None, 1.5, 1000.0, None, None, None, None, -0.5, 7.0]
    df = spark.createDataFrame([(t,) for t in ["Inf", " -inf ", "infinity", "info"]], "t string")
    out = [r[0] for r in df.coalesce(1).select(pf.to_number(F.col("t"))).collect()]
    assert out == [math.inf, -math.inf, math.inf, None]


def test_log10_and_share(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (-1.0,), (None,)], "x double").coalesce(1)
    zero, hundred, negative, missing = [r[0] for r in df.select(pf.log10(F.col("x"))).collect()]
    assert zero == -math.inf and hundred == 2.0 and math.isnan(negative) and missing is None
    one = spark.range(1)
    out = one.select(
        pf.share(F.lit(1), F.lit(4)), pf.share(F.lit(0), F.lit(0)), pf.share(F.lit(1), F.lit(0))
    ).first()
    assert tuple(out) == (0.25, None, None)


def test_labels(spark):
    out = spark.range(1).select(
        pf.number_label(F.lit(3.1e9), 1e-9, "$", "B"),
        pf.number_label(F.lit(-2.0e9), 1e-9, "$", "B"),
        pf.comma_label(F.lit(1234567)),
    )
    assert tuple(out.first()) == ("$3B", "-$2B", "1,234,567")


def test_text(spark):
    texts = ["Floods, Conflict", "Cyclone", "calm", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.coalesce(1).select(
        pf.matches_any(F.col("t"), ["Conflict", "Violence"]),
        pf.matches_any(F.col("t"), ["Fl..ds", "Cyclone"]),
        pf.matches_any(F.col("t"), ["Fl..ds"], escape=True),
        pf.first_case([(F.col("t") == "calm", 1), (F.col("t").isNotNull(), 2)]),
    )
    assert [tuple(r) for r in out.collect()] == [
        (True, True, False, 2), (False, True, False, 2), (False, False, False, 1),
        (None, None, None, None),
    ]


def test_three_valued_logic(spark):
    na = F.lit(None).cast("boolean")
    out = spark.range(1).select(F.lit(True) & na, F.lit(False) & na, F.lit(True) | na).first()
    assert tuple(out) == (None, False, True)


def test_day_in_year(spark):
    assert spark.range(1).select(pf.day_in_year(F.lit(2019))).first()[0] == dt.date(2019, 6, 1)


def test_year_between(spark):
    stamps = [dt.datetime(y, m, d) for y, m, d in
              [(1995, 12, 31), (1996, 1, 1), (2000, 12, 31), (2001, 1, 1)]] + [None]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz").coalesce(1)
    out = [r[0] for r in df.select(pf.year_between(F.col("t"), 1996, 2000)).collect()]
    assert out == [False, True, True, False, None]
    days = df.select(pf.year_between(F.to_date("t"), 1996, 2000))
    assert [r[0] for r in days.collect()] == out
