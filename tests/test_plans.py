"""Plan shape and skew: aggregates combine map-side, the planner broadcasts
dimensions by their bytes, facts are not shuffled before their joins, and a
hot key does not change results."""

import io
import contextlib

from pyspark.sql import functions as F

from cabmeter.functions.features import add_ride_features
from cabmeter.operators import dashboard, routes
from cabmeter.operators.joins import materialized_dimension


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed_rides(spark, n=30000):
    """A third of the rides share one route and one hour."""
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.col("id").alias("ride_id"),
        (F.lit(1704067200000) + F.when(hot, F.lit(8 * 3600000)).otherwise((F.col("id") % 24) * 3600000))
        .alias("time_stamp"),
        F.when(F.col("id") % 2 == 0, "Uber").otherwise("Lyft").alias("cab_type"),
        F.lit("UberX").alias("name"),
        F.when(hot, "Back Bay").otherwise(F.concat(F.lit("P"), (F.col("id") % 7).cast("string"))).alias("source"),
        F.when(hot, "Fenway").otherwise(F.concat(F.lit("Q"), (F.col("id") % 5).cast("string"))).alias("destination"),
        ((F.col("id") % 50) / 10.0 + 0.1).alias("distance"),
        F.lit(1.0).alias("surge_multiplier"),
        ((F.col("id") % 97) + 5.0).alias("price"),
    )


def test_aggregates_are_partial_before_shuffle(spark):
    feats = add_ride_features(_skewed_rides(spark))
    for df in (dashboard.hourly_stats(feats), dashboard.dashboard_grouping_sets(feats),
               routes.build_distance_map(feats)):
        plan = _plan(df)
        assert "partial_" in plan and "Exchange hashpartitioning" in plan
        # the partial aggregate sits below the first hash exchange
        assert plan.index("Exchange hashpartitioning") < plan.rindex("partial_")


def test_hot_key_results_match_plain_python(spark):
    rides = _skewed_rides(spark)
    feats = add_ride_features(rides)
    got = {r.hour: (r.ride_count, r.avg_price) for r in dashboard.hourly_stats(feats).collect()}
    pdf = feats.select("hour", "price").toPandas()
    exp = pdf.groupby("hour")["price"].agg(["count", "mean"])
    assert got.keys() == set(exp.index)
    for h, (cnt, avg) in got.items():
        assert cnt == exp.loc[h, "count"] and abs(avg - exp.loc[h, "mean"]) < 1e-9
    assert max(c for c, _ in got.values()) >= 10000


def test_route_lookup_broadcasts_a_small_map_by_its_bytes(spark):
    rides = _skewed_rides(spark)
    dmap = materialized_dimension(routes.build_distance_map(rides))
    joined = routes.lookup_distance(rides.select("ride_id", "source", "destination"), dmap)
    plan = _plan(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert joined.filter(F.col("route_distance").isNull()).count() == 0
    assert joined.count() == rides.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        again = routes.lookup_distance(rides.select("ride_id", "source", "destination"), dmap)
        assert "SortMergeJoin" in _plan(again)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rides_are_not_shuffled_and_unused_look_ups_go(spark, sf_small):
    from cabmeter.sources.rides import rides_from_tables

    rides = rides_from_tables(spark, sf_small)
    plan = _plan(rides.select("ride_id", "distance", "price"))
    assert "Exchange" not in plan and "Join" not in plan
    full = _plan(rides)
    assert "RoundRobin" not in full and full.count("BroadcastHashJoin") == 2
