"""Dashboard aggregates (A1-A8, A10, A11, A13), their orderings (T1, T2) and
the distance/price sample (R1, T4, P6).

Every aggregate is algebraic (count, sum, avg, max, regression moments), so
Spark combines it map-side before the shuffle: a hot key costs one partial
row per task, never a skewed reduce task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.calendar import day_name
from cabmeter.functions.hashing import hash32, row_key
from cabmeter.functions.text import currency, hour_text, thousands
from cabmeter.schemas import SAMPLE_PERCENT, SAMPLE_SALT, SPLIT_SEED
from cabmeter.session import fresh_dir


def hourly_aggregate(rides: DataFrame) -> DataFrame:
    """A1 without the ordering, for further aggregation."""
    return rides.groupBy("hour").agg(
        F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("ride_count"))


def hourly_stats(rides: DataFrame) -> DataFrame:
    """A1 + T1: average price and ride count per hour."""
    return hourly_aggregate(rides).orderBy("hour")


def daily_stats(rides: DataFrame) -> DataFrame:
    """A2 + F6 + T1: average price per day of week, with the day's name."""
    return (
        rides.groupBy("day_of_week")
        .agg(F.avg("price").alias("avg_price"))
        .withColumn("day_name", day_name("day_of_week"))
        .orderBy("day_of_week")
    )


def service_stats(rides: DataFrame) -> DataFrame:
    """A3: average price per (provider, service)."""
    return rides.groupBy("cab_type", "name").agg(F.avg("price").alias("avg_price"))


def top_services(service: DataFrame, k: int = 10) -> DataFrame:
    """The k services with the highest average price; ties by name. Spark
    plans this as a per-partition top-k followed by one small merge."""
    return service.orderBy(F.desc("avg_price"), "cab_type", "name").limit(k)


def surge_stats(rides: DataFrame) -> DataFrame:
    """A4 + T1: average price and ride count per surge multiplier."""
    return (
        rides.groupBy("surge_multiplier")
        .agg(F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("count"))
        .orderBy("surge_multiplier")
    )


def dashboard_kpis(hourly: DataFrame) -> DataFrame:
    """A5-A8 over the hourly table: total rides, the unweighted mean of the
    hourly means, the highest hourly mean and its hour (the earliest hour on
    a tie; the null hour never peaks). Text columns per F15/F16."""
    peak = F.max(
        F.when(F.col("hour").isNotNull(), F.struct(F.col("avg_price"), (-F.col("hour")).alias("neg_hour")))
    )
    out = hourly.agg(
        F.sum("ride_count").cast("bigint").alias("total_rides"),
        F.avg("avg_price").alias("avg_price"),
        F.max("avg_price").alias("peak_hour_price"),
        peak.alias("_peak"),
    )
    out = out.select(
        "total_rides", "avg_price", "peak_hour_price",
        (-F.col("_peak.neg_hour")).cast("int").alias("peak_hour"),
    )
    return out.withColumns(
        {
            "total_rides_text": thousands("total_rides"),
            "avg_price_text": currency("avg_price"),
            "peak_hour_price_text": currency("peak_hour_price"),
            "peak_hour_text": hour_text("peak_hour"),
        }
    )


GROUPING_SET_NAMES = {
    # grouping_id over (hour, day_of_week, cab_type, name, surge_multiplier);
    # a set bit means the column is rolled up.
    0b01111: "hourly",
    0b10111: "daily",
    0b11001: "service",
    0b11110: "surge",
}


def dashboard_grouping_sets(rides: DataFrame) -> DataFrame:
    """The four dashboard groupings from a single scan, as one
    GROUPING SETS aggregate (Expand + one partial/final hash aggregate)."""
    keys = ["hour", "day_of_week", "cab_type", "name", "surge_multiplier"]
    sets = [[F.col("hour")], [F.col("day_of_week")], [F.col("cab_type"), F.col("name")],
            [F.col("surge_multiplier")]]
    agg = rides.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("_gid"),
        F.avg("price").alias("avg_price"),
        F.count(F.lit(1)).alias("ride_count"),
    )
    label = None
    for gid, name in GROUPING_SET_NAMES.items():
        label = (F.when if label is None else label.when)(F.col("_gid") == gid, F.lit(name))
    return agg.select(label.alias("grouping_set"), *keys, "avg_price", "ride_count")


def distance_price_sample(rides: DataFrame, id_col: str = "ride_id",
                          percent: int = SAMPLE_PERCENT, cap: int | None = None,
                          seed: int = SPLIT_SEED) -> DataFrame:
    """R1 + T4 + P6: a ``percent`` % hash sample of (distance, price). The key
    is ``id_col``, or a hash of the whole row when the table has no id. The
    result does not depend on the input's partitioning. A caller that draws
    points may ask for at most ``cap`` of them, chosen by hash then key (a
    bounded top-k); without it the whole sample is returned."""
    key = row_key(rides, id_col)
    sample = (
        rides.select(key.alias("_key"), "distance", "price")
        .withColumn("_h", hash32("_key", seed, SAMPLE_SALT))
        .filter(F.col("_h") % 100 < percent)
    )
    if cap is not None:
        sample = sample.orderBy("_h", "_key").limit(cap)
    return sample.select("distance", "price")


def fare_trend(rides: DataFrame) -> DataFrame:
    """A10 + A11: least-squares line of price on distance, and the
    correlation, over the whole table in one pass."""
    return rides.agg(
        F.regr_count("price", "distance").alias("n"),
        F.regr_slope("price", "distance").alias("slope"),
        F.regr_intercept("price", "distance").alias("intercept"),
        F.regr_r2("price", "distance").alias("r2"),
        F.corr("distance", "price").alias("correlation"),
    )


def dashboard_pass(rides: DataFrame, id_col: str = "ride_id", percent: int = SAMPLE_PERCENT,
                   seed: int = SPLIT_SEED) -> DataFrame:
    """Everything the dashboard shows, from one read of the rides, as a
    Parquet table in the shared folder, partitioned by ``part``: the four
    groupings (A1-A4), the whole table (A10, A11) and the rides of the
    distance/price sample (R1) are the grouping sets of one aggregate.

    Rides outside the sample fall into one group of the last set, which each
    task combines to a row before the shuffle, so only aggregates and the
    sample are moved. Equal sampled rows are one group with a count. No copy of
    the rides is kept."""
    keys = ["hour", "day_of_week", "cab_type", "name", "surge_multiplier"]
    point = ["_sampled", "_h", "_key", "_x", "_y"]
    rows = rides.select(*keys, "distance", "price", row_key(rides, id_col).cast("string").alias("_key"))
    rows = rows.withColumn("_h", hash32("_key", seed, SAMPLE_SALT)).withColumn("_sampled", F.col("_h") % 100 < percent)
    rows = rows.select(*keys, "distance", "price", "_sampled", *[
        F.when(F.col("_sampled"), F.col(c)).alias(a)
        for c, a in (("_h", "_h"), ("_key", "_key"), ("distance", "_x"), ("price", "_y"))])
    sets = [["hour"], ["day_of_week"], ["cab_type", "name"], ["surge_multiplier"], [], point]
    every = [*keys, *point]
    agg = rows.groupingSets([[F.col(c) for c in s] for s in sets], *every).agg(
        F.grouping_id(*every).alias("_gid"), F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("ride_count"),
        F.regr_count("price", "distance").alias("n"), F.regr_slope("price", "distance").alias("slope"),
        F.regr_intercept("price", "distance").alias("intercept"), F.regr_r2("price", "distance").alias("r2"))
    part = F.lit(None).cast("string")
    for s, name in zip(sets, ("hourly", "daily", "service", "surge", "whole", "points")):
        rolled_up = sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in s)
        part = F.when(F.col("_gid") == rolled_up, F.lit(name)).otherwise(part)
    out = agg.withColumn("part", part).where("part <> 'points' OR _sampled").drop("_gid", "_sampled")
    spark, path = rides.sparkSession, fresh_dir(rides.sparkSession, "dashboard")
    out.write.partitionBy("part").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def dashboard_tables(parts: DataFrame, k: int = 10, cap: int | None = None) -> dict[str, DataFrame]:
    """The dashboard's tables from the result of ``dashboard_pass``: the same
    as those of the single operators. Each reads its partitions only."""
    of = lambda name: parts.where(F.col("part") == name)
    hourly = of("hourly").select("hour", "avg_price", "ride_count")
    service = of("service").select("cab_type", "name", "avg_price")
    points = of("points")
    if cap is None:
        points = points.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("ride_count").cast("int"))))
    else:
        # Equal rows follow one another, so no more than cap copies count.
        copies = F.sequence(F.lit(1), F.least(F.col("ride_count"), F.lit(cap)).cast("int"))
        points = points.orderBy("_h", "_key").limit(cap).withColumn("_again", F.explode(copies)).orderBy(
            "_h", "_key").limit(cap)
    # An aggregate without a group has a row also where there are no rides.
    whole = of("whole").agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("slope").alias("slope"),
                            F.max("intercept").alias("intercept"), F.max("r2").alias("r2"))
    # From the line: corr() fails on the many groups of one ride. Undefined
    # where all prices are equal (slope 0, r2 1).
    whole = whole.withColumn("correlation", F.when(
        ~((F.col("slope") == 0) & (F.col("r2") == 1)), F.signum("slope") * F.sqrt("r2")))
    return {
        "hourly": hourly.orderBy("hour"),
        "daily": of("daily").select("day_of_week", "avg_price").withColumn(
            "day_name", day_name("day_of_week")).orderBy("day_of_week"),
        "service": service, "top_services": top_services(service, k),
        "surge": of("surge").select("surge_multiplier", "avg_price", F.col("ride_count").alias("count")).orderBy(
            "surge_multiplier"),
        "kpis": dashboard_kpis(hourly), "fare_trend": whole,
        "distance_price": points.select(F.col("_x").alias("distance"), F.col("_y").alias("price")),
    }
