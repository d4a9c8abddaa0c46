import datetime as dt
import hashlib

from pyspark.sql import functions as F

from skyfold.functions import bucketize, date_attributes, safe_pct, status_in, surrogate_key, three_valued_flag
from skyfold.functions.keys import NULL_SENTINEL


def test_surrogate_key_matches_md5_with_null_sentinel(spark):
    df = spark.createDataFrame([("2026-05-06", None, "DEPARTURE")], "d string, f string, dir string")
    got = df.select(surrogate_key("d", "f", "dir").alias("k")).first().k
    want = hashlib.md5(f"2026-05-06-{NULL_SENTINEL}-DEPARTURE".encode()).hexdigest()
    assert got == want


def test_safe_pct_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 8), (1, 32), (2, 3), (1, 0), (0, 5), (5, None)], "n long, d long")
    got = [r.p for r in df.select(safe_pct("n", "d").alias("p")).collect()]
    assert got == [12.5, 3.13, 66.67, None, 0.0, None]


def test_on_time_flag_is_three_valued(spark):
    df = spark.createDataFrame(
        [(10, dt.datetime(2024, 1, 1)), (20, dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1)), (5, None)],
        "delay long, actual timestamp_ntz",
    )
    got = [r.f for r in df.select(three_valued_flag(F.col("delay") <= 15, F.col("actual")).alias("f")).collect()]
    assert got == [True, False, False, None]  # NULL delay with an actual time is FALSE (D7)


def test_delay_bucket_null_delay_falls_to_else(spark):
    df = spark.createDataFrame(
        [(0, 1), (16, 1), (45, 1), (61, 1), (None, 1), (5, None)], "delay long, actual int"
    )
    b = bucketize("delay", (15, 30, 60), ("On Time", "15-30 min", "30-60 min"), "60+ min",
                  null_when=F.col("actual").isNull())
    got = [r.b for r in df.select(b.alias("b")).collect()]
    assert got == ["On Time", "15-30 min", "30-60 min", "60+ min", "60+ min", None]


def test_cancelled_flag_any_case_null_false(spark):
    df = spark.createDataFrame([("Cancelled",), ("canceled",), ("landed",), (None,)], "s string")
    got = [r.c for r in df.select(status_in("s", ("cancelled", "canceled")).alias("c")).collect()]
    assert got == [True, True, False, False]


def test_date_attributes_contract(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),), (dt.date(2027, 1, 1),)], "d date")
    rows = df.select(*[c.alias(n) for n, c in date_attributes("d").items()]).collect()
    sun, sat, ny = rows
    assert (sun.day_of_week, sun.is_weekend, sun.day_name) == (0, True, "Sunday")
    assert (sat.day_of_week, sat.is_weekend) == (6, True)
    assert ny.week_of_year == 53 and ny.month_name == "January" and ny.year_month == "2027-01"
    assert ny.quarter == 1 and ny.day_of_year == 1
