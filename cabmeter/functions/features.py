"""Ride features (P2, P7-P10) shared by batch training, quotes and streaming.

``add_ride_features`` is the single feature function: every step runs only
when its input column exists (P2), and all new columns are added in one
projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.calendar import (
    day_of_week, hour_of_day, month_of_year, timestamp_from_millis,
)
from cabmeter.functions.columns import ident


# The hours of P7 and the miles of P10 are stated in the rules.

def time_of_day(hour: str) -> Column:
    """6-11 morning, 12-16 afternoon, 17-20 evening, anything else
    (including null) night."""
    h = ident(hour)
    return F.expr(
        f"CASE WHEN {h} BETWEEN 6 AND 11 THEN 'morning'"
        f" WHEN {h} BETWEEN 12 AND 16 THEN 'afternoon'"
        f" WHEN {h} BETWEEN 17 AND 20 THEN 'evening'"
        f" ELSE 'night' END"
    )


def is_weekend(day: str) -> Column:
    """1 for Sunday (1) and Saturday (7), else 0 (null -> 0)."""
    return F.expr(f"CASE WHEN {ident(day)} IN (1, 7) THEN 1 ELSE 0 END")


def is_surge(multiplier: str) -> Column:
    """1 when the multiplier exceeds 1.0, else 0 (null -> 0)."""
    return F.expr(f"CASE WHEN {ident(multiplier)} > 1.0D THEN 1 ELSE 0 END")


def distance_category(distance: str) -> Column:
    """P10: < 1 short, < 3 medium, anything else (null, NaN) long."""
    d = ident(distance)
    return F.expr(f"CASE WHEN {d} < 1 THEN 'short' WHEN {d} < 3 THEN 'medium' ELSE 'long' END")


def add_calendar(df: DataFrame, timestamp_col: str = "time_stamp") -> DataFrame:
    """F1-F4 from epoch milliseconds; a no-op when the column is absent."""
    if timestamp_col not in df.columns:
        return df
    ts = timestamp_from_millis(timestamp_col)
    df = df.withColumn("timestamp_converted", ts)
    return df.withColumns(
        {
            "hour": hour_of_day("timestamp_converted"),
            "day_of_week": day_of_week("timestamp_converted"),
            "month": month_of_year("timestamp_converted"),
        }
    )


def add_ride_features(df: DataFrame, timestamp_col: str = "time_stamp") -> DataFrame:
    """Calendar fields (if a timestamp is present) and P7-P10 (each only if its
    input column is present). Requests and stream messages carry hour, day and
    month already; training rows carry the timestamp."""
    df = add_calendar(df, timestamp_col)
    cols = set(df.columns)
    new: dict[str, Column] = {}
    if "hour" in cols:
        new["time_of_day"] = time_of_day("hour")
    if "day_of_week" in cols:
        new["is_weekend"] = is_weekend("day_of_week")
    if "surge_multiplier" in cols:
        new["is_surge"] = is_surge("surge_multiplier")
    if "distance" in cols:
        new["distance_category"] = distance_category("distance")
    return df.withColumns(new) if new else df
