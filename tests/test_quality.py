"""Data checks on seeded violations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import quality as Q

DAY = dt.date(2024, 1, 1)


def test_malformed_dates(spark, rows):
    texts = spark.createDataFrame([("2019-01-01",), ("2019-01-01T00:00",), ("01-01-2019",), (None,)], "d string")
    assert rows(Q.malformed_dates(texts, "d")) == [("01-01-2019",), (None,)]


def test_duplicate_dates(spark, rows):
    table = spark.createDataFrame([(DAY,), (DAY,), (dt.date(2024, 1, 9),)], "submission_date date")
    assert rows(Q.duplicate_dates(table, "2024-01-01", "2024-01-08")) == [(DAY, 2)]
    assert Q.duplicate_dates(table, "2024-01-02", "2024-01-08").isEmpty()


def test_uneven_denominators(spark, rows):
    df = spark.createDataFrame([(5, 5), (5, 4), (5, None)], "day_chan_os_sum long, day_chan_os_sum_min long")
    assert rows(Q.uneven_denominators(df)) == [(5, 4), (5, None)]


def test_not_one_to_one(spark, rows):
    df = spark.createDataFrame([("b1", 1), ("b1", 1), ("b2", 1), ("b2", 2)], "build_id string, pub_date int")
    assert rows(Q.not_one_to_one(df, "build_id", "pub_date")) == [("b2", 2)]


def test_changed_rows(spark, rows):
    before = spark.createDataFrame([(1,), (2,), (2,)], "n int")
    assert Q.changed_rows(before, before.withColumn("extra", F.lit(0))).isEmpty()
    after = spark.createDataFrame([(2, 0), (3, 0), (1, 0)], "n int, extra int")
    assert rows(Q.changed_rows(before, after)) == [(2, "lost"), (3, "added")]


def test_early_submissions(spark, rows):
    df = spark.createDataFrame([(DAY, DAY + dt.timedelta(days=k)) for k in (0, 1, 2)] + [(DAY, None)], "submission_date date, pub date")
    assert rows(Q.early_submissions(df, "pub"), "days_post_pub") == [(-2,)]


def test_non_integer_majors(spark, rows):
    df = spark.createDataFrame([("70",), ("71.0",), ("14.5",), ("14.0.1",)], "version string")
    assert rows(Q.non_integer_majors(df)) == [("14.0.1",), ("14.5",)]


def test_value_differences(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n int, v string")
    b = spark.createDataFrame([("x", 1), ("z", 2)], "v string, n int")
    assert rows(Q.value_differences(a, b)) == [(1, "x", "first"), (2, "y", "first"), (2, "z", "second")]


def test_conform(spark, rows):
    schema = T.StructType().add("d", "date").add("n", "long")
    df = spark.createDataFrame([("7", "2024-01-01"), ("many", "2024-01-02"), (None, "soon")], "n string, d string")
    for broken in (df.where("n = 'many'"), df.where("d = 'soon'")):
        with pytest.raises(Exception, match="cannot hold (many|soon)"):
            Q.conform(broken, schema).collect()
    got = Q.conform(df, schema, strict=False)
    assert got.schema == schema
    assert rows(got) == [(DAY, 7), (dt.date(2024, 1, 2), None), (None, None)]
    assert rows(Q.lost_casts(df, schema)) == [("d", 1), ("n", 1)]
    assert Q.conform(df, schema, {"n": T.StringType()}).schema["n"].dataType == T.StringType()


@pytest.mark.parametrize("columns, overrides, message", [
    ("d string, n string", {"x": T.LongType()}, "unknown columns"),
    ("d string, n string", {"n": "long"}, "must be Spark types"),
    ("d string, n string, x string", {}, "without a declared type"),
    ("d string", {}, "missing"),
])
def test_conform_rejects(spark, columns, overrides, message):
    schema = T.StructType().add("d", "date").add("n", "long")
    with pytest.raises(Q.QualityError, match=message):
        Q.conform(spark.createDataFrame([], columns), schema, overrides)


def test_schemas_cover_the_tables():
    assert schemas.VERSION_COUNTS["n"].dataType == T.LongType()
    assert len(schemas.CURVES) == 17
