import math

import pytest
from pyspark.sql import functions as F

from cabmeter.functions import calendar, features, surge

# Golden table for the suggested surge: (first hour, last hour, Mon-Thu, Fri-Sun).
SURGE_GOLDEN = [
    (0, 3, 1.5, 2.0), (4, 4, 1.5, 1.5), (5, 6, 1.25, 1.25), (7, 9, 1.75, 1.75),
    (10, 14, 1.0, 1.25), (15, 16, 1.0, 1.0), (17, 19, 2.0, 2.0), (20, 21, 1.25, 1.25),
    (22, 23, 1.25, 1.75),
]


def _expected_surge(hour, day):
    for first, last, weekday, weekend in SURGE_GOLDEN:
        if first <= hour <= last:
            return weekend if day in (1, 6, 7) else weekday
    raise AssertionError(hour)


def test_suggested_surge_golden_168(spark):
    grid = spark.range(168).select((F.col("id") % 24).cast("int").alias("hour"),
                                   (F.col("id") / 24 + 1).cast("int").alias("day_of_week"))
    rows = grid.select("hour", "day_of_week",
                       surge.suggested_surge("hour", "day_of_week").alias("s")).collect()
    assert len(rows) == 168
    for r in rows:
        assert r.s == _expected_surge(r.hour, r.day_of_week), (r.hour, r.day_of_week)


def test_time_of_day_edges(spark):
    cases = {5: "night", 6: "morning", 11: "morning", 12: "afternoon", 16: "afternoon",
             17: "evening", 20: "evening", 21: "night", None: "night"}
    df = spark.createDataFrame([(h,) for h in cases], "hour int")
    got = {r.hour: r.t for r in df.select("hour", features.time_of_day("hour").alias("t")).collect()}
    assert got == cases


def test_distance_category_edges_null_nan(spark):
    cases = [(0.99, "short"), (1.0, "medium"), (2.99, "medium"), (3.0, "long"),
             (None, "long"), (float("nan"), "long")]
    df = spark.createDataFrame([(d,) for d, _ in cases], "distance double")
    got = [r.c for r in df.select(features.distance_category("distance").alias("c")).collect()]
    assert sorted(got) == sorted(c for _, c in cases)


def test_flags_null_to_zero(spark):
    df = spark.createDataFrame([(1, 1.5), (7, 1.0), (3, None), (None, 2.0)],
                               "day_of_week int, surge_multiplier double")
    out = df.select(features.is_weekend("day_of_week").alias("w"),
                    features.is_surge("surge_multiplier").alias("s")).collect()
    assert [(r.w, r.s) for r in out] == [(1, 1), (1, 0), (0, 0), (0, 1)]


def test_column_guard(spark):
    df = spark.createDataFrame([(1.0,)], "price double")
    assert features.add_ride_features(df).columns == ["price"]
    df2 = spark.createDataFrame([(2.5, 1.5)], "distance double, surge_multiplier double")
    assert set(features.add_ride_features(df2).columns) == {
        "distance", "surge_multiplier", "is_surge", "distance_category"}


def test_calendar_is_utc_whatever_the_session_zone(spark):
    # 2024-01-06 (a Saturday) 23:30:00 UTC
    ms = 1704583800000
    df = spark.createDataFrame([(ms,)], "time_stamp long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        r = features.add_calendar(df).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.hour, r.day_of_week, r.month) == (23, 7, 1)


def test_day_names(spark):
    df = spark.createDataFrame([(d,) for d in range(0, 9)], "d int")
    got = [r.n for r in df.orderBy("d").select(calendar.day_name("d").alias("n")).collect()]
    assert got == [None, "Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", None]


def test_clean_rides_null_nan(spark):
    from cabmeter.operators.clean import clean_rides

    rows = [(1, 10.0, 2.0), (2, None, 2.0), (3, 0.0, 2.0), (4, 5.0, 0.0), (5, 5.0, None),
            (6, float("nan"), 1.0), (7, -1.0, 1.0)]
    df = spark.createDataFrame(rows, "ride_id long, price double, distance double")
    assert sorted(r.ride_id for r in clean_rides(df).collect()) == [1, 6]
    assert [r.ride_id for r in clean_rides(df, drop_nan=True).collect()] == [1]


def test_wall_clock_millis_round_trip_across_dst(spark):
    import datetime

    rows = [(datetime.datetime(2024, 7, 1, 12, 0, 0, 123456),), (datetime.datetime(2024, 1, 1, 0, 9, 58, 778549),),
            (datetime.datetime(2024, 3, 10, 2, 30, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    epoch = datetime.datetime(1970, 1, 1)
    expected = [(r[0] - epoch) // datetime.timedelta(milliseconds=1) for r in rows]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = df.select(calendar.millis_from_wall_clock("ts").alias("ms")).collect()
        back = features.add_calendar(spark.createDataFrame([(e,) for e in expected], "time_stamp long")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.ms for r in out] == expected
    assert [(r.hour, r.month) for r in back] == [(12, 7), (0, 1), (2, 3)]
