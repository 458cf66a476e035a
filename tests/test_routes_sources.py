import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabmeter.functions.surge import fill_suggested_surge
from cabmeter.operators import routes
from cabmeter.schemas import REQUEST, RIDES
from cabmeter.sources.layout import cast_failures
from cabmeter.sources.requests import read_requests_csv, requests_from_records
from cabmeter.sources.rides import load_profile, read_rides_csv
from cabmeter.sources.routes import read_distance_map_csv


def _tmp(name, content):
    d = tempfile.mkdtemp(prefix="cabmeter-fixture-")
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(content)
    return p


MAP_CSV = """source,destination,max_distance
 North End ,SOUTH STATION,3.25
South Station,North End,3.5
North End,Beacon Hill,2.0
north end,beacon hill,2.75
West End,Fenway,4.5
"""


def test_distance_map_csv_and_lookup(spark):
    dmap = read_distance_map_csv(spark, _tmp("map.csv", MAP_CSV))
    got = {(r.source, r.destination): r.max_distance for r in dmap.collect()}
    # normalised keys, duplicate key -> larger distance, directed
    assert got == {("north end", "south station"): 3.25, ("south station", "north end"): 3.5,
                   ("north end", "beacon hill"): 2.75, ("west end", "fenway"): 4.5}
    reqs = spark.createDataFrame(
        [(1, "North End", "South Station"), (2, "south station ", "NORTH END"), (3, "Fenway", "West End"),
         (4, "Nowhere", "Fenway")], "id long, source string, destination string")
    out = {r.id: r.route_distance for r in routes.lookup_distance(reqs, dmap).collect()}
    assert out == {1: 3.25, 2: 3.5, 3: None, 4: None}


def test_quote_request_checks(spark):
    dmap = read_distance_map_csv(spark, _tmp("map.csv", MAP_CSV))
    good = dict(cab_type="Uber", name="UberX", source="North End", destination="South Station",
                surge_multiplier=1.5, hour=9, day_of_week=2, month=4)
    lyft = {**good, "cab_type": "Lyft", "name": "Shared"}
    recs = [
        good, {**good, "destination": "North End"}, {**good, "name": "Lux"}, {**lyft, "source": "Old Mill"},
        {**lyft, "destination": "Boston University"}, {**lyft, "hour": 24}, {**lyft, "day_of_week": 8},
        {**lyft, "month": 0}, {**lyft, "surge_multiplier": 3.5},
        {**lyft, "source": "West End", "destination": "Fenway", "surge_multiplier": 3.0},
        {**lyft, "source": "Fenway", "destination": "West End", "surge_multiplier": 3.0},
    ]
    reqs = requests_from_records(spark, recs).drop("distance")
    reqs = reqs.withColumn("i", F.monotonically_increasing_id())
    out = [r.reject_reason for r in routes.check_quote_requests(reqs, dmap).orderBy("i").collect()]
    assert out == [None, "same_endpoints", "unknown_service", "unknown_source", "unknown_destination",
                   "bad_hour", "bad_day", "bad_month", "bad_surge", None, "unknown_route"]


def test_rides_csv_and_profile(spark):
    csv = ("ride_id,time_stamp,cab_type,name,source,destination,distance,surge_multiplier,price\n"
           "1,1700000000000,Lyft,Shared,Harbour,Market,2.25,1.0,9.5\n"
           "2,1700000600000,Uber,UberX,Market,Quay,4.5,1.25,\n")
    p = _tmp("rides.csv", csv)
    df = read_rides_csv(spark, p)
    assert dict(df.dtypes)["time_stamp"] == "bigint" and dict(df.dtypes)["price"] == "double"
    prof = load_profile(df).first()
    assert (prof.row_count, prof.column_count) == (2, 9)
    inferred = read_rides_csv(spark, p, infer_schema=True)
    assert inferred.count() == 2


def test_rides_csv_in_another_column_order(spark):
    """Another column order, a text id and extra columns: typing goes by name."""
    csv = ("distance,cab_type,time_stamp,destination,source,price,surge_multiplier,id,product_id,name\n"
           "2.25,Lyft,1700000000000,Market,Harbour,9.5,1.0,a1,p1,Shared\n"
           "4.5,Uber,1700000600000,Quay,Market,,1.25,a2,p2,UberX\n")
    df = read_rides_csv(spark, _tmp("cab_rides.csv", csv))
    types = dict(df.dtypes)
    assert types["distance"] == "double" and types["time_stamp"] == "bigint" and types["id"] == "string"
    rows = {r.id: r for r in df.collect()}
    assert rows["a1"].price == 9.5 and rows["a1"].source == "Harbour"
    assert rows["a2"].price is None and rows["a2"].surge_multiplier == 1.25


def test_files_with_different_headers(spark):
    d = os.path.dirname(_tmp("a.csv", "cab_type,name,distance,surge_multiplier,hour\nUber,UberX,4.5,1.25,6\n"))
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("hour,extra,surge_multiplier,distance,name,cab_type\n7.0,x,1.5,2.0,Lux,Lyft\nbad,y,1,3,Lux,Lyft\n")
    rows = sorted((r.cab_type, r.name, r.distance, r.surge_multiplier, r.hour, r.extra)
                  for r in read_requests_csv(spark, d, mixed_headers=True).where("hour IS NOT NULL").collect())
    assert rows == [("Lyft", "Lux", 2.0, 1.5, 7, "x"), ("Uber", "UberX", 4.5, 1.25, 6, None)]
    # Without the option the read fails rather than mixing up columns.
    with pytest.raises(Exception, match="(?i)header"):
        read_requests_csv(spark, d).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_requests_csv(spark, d).select("distance").collect()
    bad = cast_failures(spark, d, REQUEST, mixed_headers=True).first()
    assert bad.hour == 1 and bad.distance == 0


def test_whole_numbers_written_as_floats(spark):
    p = _tmp("rides.csv", "time_stamp,price\n1700000000000.0,1\n1.7E12,2\n1.5,3\n,4\n9e30,5\n1700000000001,6\n")
    got = [r.time_stamp for r in read_rides_csv(spark, p).orderBy("price").collect()]
    assert got == [1700000000000, 1700000000000, None, None, None, 1700000000001]
    assert cast_failures(spark, p, RIDES).first().asDict() == {"time_stamp": 2, "price": 0}


def test_request_csv_and_records(spark):
    csv = ("cab_type,name,source,destination,distance,surge_multiplier,hour,day_of_week,month\n"
           "Uber,UberX,Harbour,Old Mill,4.75,1.25,11,2,9\n")
    r = read_requests_csv(spark, _tmp("req.csv", csv)).first()
    assert r.distance == 4.75 and r.hour == 11
    recs = requests_from_records(spark, [dict(cab_type="Uber", name="UberX", source="a", destination="b",
                                              distance=3, surge_multiplier=1, hour=5.0, day_of_week=2,
                                              month="7")]).first()
    assert (recs.distance, recs.surge_multiplier, recs.hour, recs.month) == (3.0, 1.0, 5, 7)


def test_surge_fill(spark):
    rows = [(1, None, 8, 2), (2, 1.25, 8, 2), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id int, surge_multiplier double, hour int, day_of_week int")
    got = {r.id: r.surge_multiplier for r in fill_suggested_surge(df).collect()}
    assert got == {1: 1.75, 2: 1.25, 3: 1.25}
