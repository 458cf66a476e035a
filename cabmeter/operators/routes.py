"""Routes: build the distance map (A12), look routes up (J1, F5) and check
quote requests (P11, P12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.text import normalize_key
from cabmeter.schemas import DESTINATION_LOCATIONS, SERVICES, SOURCE_LOCATIONS


def build_distance_map(rides: DataFrame) -> DataFrame:
    """The longest observed distance per directed route, keyed by the
    normalised (trimmed, lower-cased) endpoints. Partial aggregation runs
    before the shuffle, so a route holding a third of all rides costs one row
    per task."""
    return (
        rides.filter(F.col("source").isNotNull() & F.col("destination").isNotNull())
        .groupBy(normalize_key("source").alias("source"),
                 normalize_key("destination").alias("destination"))
        .agg(F.max("distance").alias("max_distance"))
    )


def normalize_distance_map(dmap: DataFrame) -> DataFrame:
    """F5 on a given map plus de-duplication on the normalised key (max wins),
    so the look-up returns at most one distance per route. Routes are
    directed and never symmetrised."""
    return (
        dmap.groupBy(normalize_key("source").alias("source"),
                     normalize_key("destination").alias("destination"))
        .agg(F.max("max_distance").alias("max_distance"))
    )


def lookup_distance(requests: DataFrame, dmap: DataFrame,
                    out_col: str = "route_distance") -> DataFrame:
    """Left join on the normalised (source, destination); a missing route
    gives null. ``dmap`` must be unique on its key (``build_distance_map`` and
    ``normalize_distance_map`` both are).

    The join strategy is the planner's: it broadcasts a map whose bytes are
    within its threshold (``materialized_dimension`` gives a derived map file
    sizes), else it sorts and merges, and AQE splits hot routes."""
    keyed = requests.withColumns(
        {"_src": normalize_key("source"), "_dst": normalize_key("destination")}
    )
    m = dmap.select(
        F.col("source").alias("_src"), F.col("destination").alias("_dst"),
        F.col("max_distance").alias(out_col),
    )
    return keyed.join(m, ["_src", "_dst"], "left").drop("_src", "_dst")


def _allowed_service(cab_type: Column, name: Column) -> Column:
    cond = None
    for provider, services in SERVICES.items():
        term = (cab_type == provider) & name.isin(*services)
        cond = term if cond is None else cond | term
    return F.coalesce(cond, F.lit(False))


def check_quote_requests(requests: DataFrame, dmap: DataFrame,
                         sources: DataFrame | None = None,
                         destinations: DataFrame | None = None) -> DataFrame:
    """P11 + P12: the request's distance comes from the route map; each
    request gets the first failing ``reject_reason`` or null when valid.

    ``sources`` / ``destinations`` are one-column (``place``) domains; by
    default the fixed location lists, which are literal predicates like the
    provider catalogue. A given domain is matched through a left join with a
    flag column (a semi/anti join that keeps every row)."""
    def flagged(df: DataFrame, domain: DataFrame | None, fixed: list[str], key: str, name: str) -> DataFrame:
        if domain is None:
            return df.withColumn(name, F.when(F.col(key).isin(*[p.lower() for p in fixed]), F.lit(True)))
        keyed = domain.groupBy(normalize_key("place").alias(key)).agg(F.first(F.lit(True)).alias(name))
        return df.join(keyed, key, "left")

    df = requests.withColumns(
        {"_src": normalize_key("source"), "_dst": normalize_key("destination")}
    )
    df = flagged(df, sources, SOURCE_LOCATIONS, "_src", "_src_ok")
    df = flagged(df, destinations, DESTINATION_LOCATIONS, "_dst", "_dst_ok")
    # The quoted distance is always the map's; a distance given with the
    # request is replaced.
    df = lookup_distance(df.drop("_src", "_dst", "distance"), dmap, out_col="distance")

    h, d, m, s = F.col("hour"), F.col("day_of_week"), F.col("month"), F.col("surge_multiplier")
    reason = (
        F.when(normalize_key("source") == normalize_key("destination"), F.lit("same_endpoints"))
        .when(~_allowed_service(F.col("cab_type"), F.col("name")), F.lit("unknown_service"))
        .when(F.col("_src_ok").isNull(), F.lit("unknown_source"))
        .when(F.col("_dst_ok").isNull(), F.lit("unknown_destination"))
        .when(~F.coalesce(h.between(0, 23), F.lit(False)), F.lit("bad_hour"))
        .when(~F.coalesce(d.between(1, 7), F.lit(False)), F.lit("bad_day"))
        .when(~F.coalesce(m.between(1, 12), F.lit(False)), F.lit("bad_month"))
        .when(~F.coalesce(s.between(1.0, 3.0), F.lit(False)), F.lit("bad_surge"))
        .when(F.col("distance").isNull(), F.lit("unknown_route"))
    )
    return df.withColumn("reject_reason", reason).drop("_src_ok", "_dst_ok")
