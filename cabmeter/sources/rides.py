"""Ride history: CSV scan (S1), load profile (S2) and the rides derived from
the driver's test tables (``events`` + ``nation``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabmeter.functions.calendar import millis_from_wall_clock
from cabmeter.functions.columns import sql_literal
from cabmeter.sources.layout import read_csv_by_name
from cabmeter.schemas import RIDES, SERVICES


def read_rides_csv(spark: SparkSession, path: str, infer_schema: bool = False,
                   mixed_headers: bool = False) -> DataFrame:
    """Rides CSV with a header line. Known columns are typed by name from
    ``RIDES`` (any order, extra columns kept as text, missing ones absent),
    so no inference pass over the data is needed; ``infer_schema=True``
    restores Spark's inference instead."""
    if infer_schema:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return read_csv_by_name(spark, path, RIDES, mixed_headers)


def load_profile(df: DataFrame) -> DataFrame:
    """Row count and column count in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("int").alias("column_count"),
    )


# Test-data mapping: rides come from ``events``, the only table with times of
# day. Places are nation names keyed by ``user_id`` and ``event_id``.
NATION_KEYS = 25

# event_type -> service index within a provider's catalogue (anything else
# maps to the last service).
_EVENT_SERVICE = {"click": 0, "view": 1, "purchase": 2, "signup": 3}


def _service_name_sql(cab_type: str, event_type: str) -> str:
    def pick(i: int) -> str:
        return (f"CASE WHEN {cab_type} = 'Uber' THEN {sql_literal(SERVICES['Uber'][i])}"
                f" ELSE {sql_literal(SERVICES['Lyft'][i])} END")

    whens = " ".join(f"WHEN {event_type} = {sql_literal(e)} THEN {pick(i)}"
                     for e, i in _EVENT_SERVICE.items())
    return f"CASE {whens} ELSE {pick(4)} END"


# Read schemas of the two input tables (no footer-based inference).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
NATION = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
])


def rides_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with the ``RIDES`` schema derived from ``events`` and ``nation``.

    The nation dimension is made unique on its key, so the planner may drop a
    look-up whose column a query does not read, and broadcasts it by its size,
    so the events are not shuffled.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    nation = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("place")
    )
    places = nation.groupBy("key").agg(F.min("place").alias("place"))
    src = places.select(F.col("key").alias("src_key"), F.col("place").alias("source"))
    dst = places.select(F.col("key").alias("dst_key"), F.col("place").alias("destination"))

    # json_tuple is a generator: the JSON is parsed once per row, and filters
    # on the derived distance / price cannot re-inline the parse.
    events = events.select("*", F.json_tuple("props", "k").alias("k"))
    cab_type = "CASE WHEN user_id % 2 = 0 THEN 'Uber' ELSE 'Lyft' END"
    base = events.select(
        F.col("event_id").alias("ride_id"),
        millis_from_wall_clock("ts").alias("time_stamp"),
        F.expr(cab_type).alias("cab_type"),
        F.expr(_service_name_sql(f"({cab_type})", "event_type")).alias("name"),
        F.expr(f"user_id % {NATION_KEYS}").alias("src_key"),
        F.expr(f"event_id % {NATION_KEYS}").alias("dst_key"),
        F.expr("try_cast(k AS DOUBLE) / 10.0D").alias("distance"),
        F.expr("1.0D + CAST(user_id % 5 AS DOUBLE) * 0.25D").alias("surge_multiplier"),
        "value",
    )
    price = F.expr(
        "CASE WHEN ride_id % 97 = 0 THEN CAST(NULL AS DOUBLE)"
        " WHEN ride_id % 101 = 0 THEN 0.0D"
        " ELSE 5.0D + 2.5D * distance * surge_multiplier + value * 0.01D END"
    )
    joined = base.join(src, "src_key", "left").join(dst, "dst_key", "left")
    return joined.select(
        "ride_id", "time_stamp", "cab_type", "name", "source", "destination",
        "distance", "surge_multiplier", price.alias("price"),
    )
