"""Trap decisions T1, T2, T3, T21, P12, P6 on micro rows."""
import datetime as dt

from pyspark.sql import functions as F

from rekindle.functions import exprs as X


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_floor_days_floors_fractional_day(spark):
    # bought D 17:55, t0 D+10 (midnight) -> 9 (datediff would say 10)
    v = one(spark, X.floor_days("t0", "t"), "t0 date, t timestamp_ntz",
            (dt.date(2024, 1, 11), dt.datetime(2024, 1, 1, 17, 55)))
    assert v == 9


def test_floor_days_negative_rounds_down(spark):
    # registered one hour after t0 midnight -> -0.04 days -> -1
    v = one(spark, X.floor_days("t0", "t"), "t0 date, t timestamp_ntz",
            (dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 1, 0)))
    assert v == -1


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)], "n double, d double")
    got = [r.x for r in df.select(X.safe_div("n", "d").alias("x")).collect()]
    assert got == [None, None, None, 1.5]


def test_missing_coupon_counts_as_used(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-5.0,)], "c double")
    got = [r.x for r in df.select(X.nonzero_or_null("c").cast("int").alias("x")).collect()]
    assert got == [1, 0, 1]


def test_flag_null_comparison_is_zero(spark):
    df = spark.createDataFrame([(None,), (400,)], "s long")
    got = [r.x for r in df.select(X.flag(F.col("s") > 365).alias("x")).collect()]
    assert got == [0, 1]


def test_discount_floor(spark):
    df = spark.createDataFrame([(0.0,), (0.005,), (None,), (0.2,)], "r double")
    got = [r.x for r in df.select(X.discount_floor("r").alias("x")).collect()]
    assert got == [0.01, 0.01, None, 0.2]


def test_threshold_clip_and_truncation(spark):
    df = spark.createDataFrame([(5,), (200,), (15,)], "ci int")
    got = [r.x for r in df.select(X.dormancy_threshold("ci", 3.0, 30, 365).alias("x")).collect()]
    assert got == [30, 365, 45]


def test_sentinel(spark):
    df = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(1990, 5, 1),)], "d date")
    got = [r.x for r in df.select(X.sentinel_to_null("d", dt.date(1900, 1, 1)).alias("x")).collect()]
    assert got == [None, dt.date(1990, 5, 1)]
