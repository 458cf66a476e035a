import os
import tempfile

from cabmeter import cli
from cabmeter.sources.rides import rides_from_tables


def test_cli_train_dashboard_quote_scenarios(spark, sf_small, capsys):
    d = tempfile.mkdtemp(prefix="cabmeter-cli-")
    rides_csv = os.path.join(d, "rides")
    rides_from_tables(spark, sf_small).write.option("header", True).csv(rides_csv)
    map_csv = os.path.join(d, "map.csv")
    with open(map_csv, "w") as f:
        f.write("source,destination,max_distance\nNorth End,South Station,3.25\nSouth Station,North End,3.5\n")

    cli.main(["train", "--rides", rides_csv, "--model-out", os.path.join(d, "model")])
    out = capsys.readouterr().out
    assert "1000" in out and "rmse" in out and "prediction" in out

    cli.main(["dashboard", "--rides", rides_csv, "--out", os.path.join(d, "dash")])
    hourly = spark.read.parquet(os.path.join(d, "dash", "hourly"))
    kpis = spark.read.parquet(os.path.join(d, "dash", "kpis")).first()
    assert kpis.total_rides == sum(r.ride_count for r in hourly.collect()) == 967

    cli.main(["scenarios"])
    out = capsys.readouterr().out
    assert "$24.00" in out and "$60.00" in out and "$36.00" in out

    cli.main(["quote", "--model", os.path.join(d, "model"), "--distance-map", map_csv,
              "--cab-type", "Uber", "--name", "UberX", "--source", "North End",
              "--destination", "South Station", "--hour", "8", "--day", "2", "--month", "6"])
    out = capsys.readouterr().out
    assert "3.25" in out and "1.75" in out and "predicted_price" in out and "$" in out


def test_cli_on_the_original_file_layout(spark, sf_small, capsys):
    """Columns in the original file's order, a text id, no ride_id."""
    from pyspark.sql import functions as F

    d = tempfile.mkdtemp(prefix="cabmeter-cli-")
    path = os.path.join(d, "cab_rides")
    rides = rides_from_tables(spark, sf_small)
    rides.select("distance", "cab_type", "time_stamp", "destination", "source", "price",
                 "surge_multiplier", F.concat(F.lit("r"), F.col("ride_id").cast("string")).alias("id"),
                 F.lit("p").alias("product_id"), "name").write.option("header", True).csv(path)
    cli.main(["train", "--rides", path, "--model-out", os.path.join(d, "model"), "--id-col", "id"])
    assert "1000" in capsys.readouterr().out
    cli.main(["dashboard", "--rides", path, "--out", os.path.join(d, "dash")])
    sample = spark.read.parquet(os.path.join(d, "dash", "distance_price"))
    assert 0 < sample.count() <= 1000
    cli.main(["dashboard", "--rides", path, "--out", os.path.join(d, "dash"), "--points", "5"])
    assert spark.read.parquet(os.path.join(d, "dash", "distance_price")).count() == 5


def test_cli_publish_and_score_stream_offline(spark, sf_small):
    """publish -> message files -> score-stream (available now) -> Parquet,
    including one malformed number that goes to the rejects."""
    d = tempfile.mkdtemp(prefix="cabmeter-cli-")
    rides_csv = os.path.join(d, "rides")
    rides_from_tables(spark, sf_small).write.option("header", True).csv(rides_csv)
    cli.main(["train", "--rides", rides_csv, "--model-out", os.path.join(d, "model")])
    req = os.path.join(d, "requests.csv")
    with open(req, "w") as f:
        f.write("cab_type,name,source,destination,distance,surge_multiplier,hour,day_of_week,month\n"
                "Uber,UberX,Harbour,Old Mill,4.75,1.25,11,2,9\n"
                "Lyft,Lyft XL,Old Mill,Harbour,6.5,1.0,16,5,2\n"
                "Uber,Black,Quay,Market,oops,1.5,20,6,3\n")
    cli.main(["publish", "--requests", req, "--out-dir", os.path.join(d, "msgs")])
    cli.main(["score-stream", "--messages-dir", os.path.join(d, "msgs"), "--model", os.path.join(d, "model"),
              "--checkpoint", os.path.join(d, "ck"), "--sink", "parquet", "--out", os.path.join(d, "scores"),
              "--rejects-out", os.path.join(d, "rejects"), "--available-now"])
    scores = spark.read.parquet(os.path.join(d, "scores")).collect()
    rejects = spark.read.parquet(os.path.join(d, "rejects")).collect()
    assert sorted(r.name for r in scores) == ["Lyft XL", "UberX"]
    assert {r.batch_id for r in scores} == {0}
    assert {"key", "topic", "partition", "offset", "predicted_price"} <= set(scores[0].asDict())
    assert {r.topic for r in scores} == {"cab_price_features"}
    assert all(r.predicted_price == r.predicted_price for r in scores)  # not NaN
    assert [r.reject_reason for r in rejects] == ["invalid_distance"]
