"""A check must fail whatever is read of its result, even only the number of rows."""

import pytest
from panelkit import operators as op
from pyspark.sql import functions as F

BAD = Exception


@pytest.fixture(scope="module")
def repeated(spark):
    return spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")


def everywhere(df, *names):
    with pytest.raises(BAD):
        df.count()
    for name in names:
        with pytest.raises(BAD):
            df.select(name).collect()


def test_unique_keys(repeated):
    everywhere(op.require_unique(repeated, "k"), "k", "v")
    assert op.require_unique(repeated.where("v > 1"), "k").count() == 2


def test_group_constants(repeated):
    df = op.group_constant(repeated, ["k"], ["v"], {})
    everywhere(df, "k", "v")


def test_coordinates(spark):
    points = spark.createDataFrame([(1, 0.0, 95.0)], "id int, longitude double, latitude double")
    everywhere(op.point_columns(points), "id", "longitude")
    assert op.point_columns(points, bad="drop").count() == 0


def test_recode_does_not_multiply_rows(repeated, spark):
    rows = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="repeat"):
        op.recode(rows, "k", repeated, "code", unique=True)
    assert op.recode(rows, "k", repeated, "code").select(F.col("code")).collect() == [(None,)]
