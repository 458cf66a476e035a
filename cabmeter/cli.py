"""Command-line jobs matching the original programs: train, stream scoring,
publishing, the dashboard tables, a single quote and the fare scenarios.

    python -m cabmeter.cli train --rides rides.csv --model-out models/fare
    python -m cabmeter.cli score-stream --bootstrap host:9092 --model models/fare --checkpoint ck/
    python -m cabmeter.cli publish --requests ride_features.csv --bootstrap host:9092
    (offline: publish --out-dir msgs/, then score-stream --messages-dir msgs/ --available-now)
    python -m cabmeter.cli dashboard --rides rides.csv --out dashboard/
    python -m cabmeter.cli quote --model models/fare --distance-map map.csv \\
        --cab-type Uber --name UberX --source "Back Bay" --destination Fenway --hour 8 --day 2 --month 6
    python -m cabmeter.cli scenarios --distance 10 --rate 2.5 --fee 5.0

The session comes from ``SparkSession.builder.getOrCreate()`` (configure it
with spark-submit); files go to paths every executor can reach.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cabmeter.schemas import REQUEST_TOPIC


def _load(args):
    """``--model`` alone is a combined model; with ``--regressor`` it is the
    preprocessing pipeline and the regressor is loaded from its own folder."""
    from cabmeter.operators.model import load_model, load_model_pair

    if getattr(args, "regressor", None):
        return load_model_pair(args.model, args.regressor)
    return load_model(args.model)


def _session() -> SparkSession:
    spark = (SparkSession.builder.appName("cabmeter")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _options(args) -> dict[str, str]:
    """``--option key=value`` pairs."""
    return dict(o.split("=", 1) for o in args.option or [])


def train(args) -> None:
    """Rides CSV -> clean -> features -> split -> fit -> evaluate -> save."""
    from cabmeter.functions.features import add_ride_features
    from cabmeter.operators import model as m
    from cabmeter.operators.clean import clean_rides
    from cabmeter.sources.rides import load_profile, read_rides_csv

    spark = _session()
    rides = read_rides_csv(spark, args.rides, infer_schema=args.infer_schema)
    load_profile(rides).show()
    feats = add_ride_features(clean_rides(rides))
    train_df, test_df = m.split_train_test(feats, id_col=args.id_col)
    model = m.fit_fare_model(train_df)
    preds, metrics = m.evaluate(model, test_df)
    metrics.show()
    m.prediction_preview(preds, id_col=args.id_col if args.id_col in preds.columns else "price").show()
    m.save_model(model, args.model_out)
    print(f"wrote the fitted pipeline to {args.model_out}")


def score_stream(args) -> None:
    """Request messages (Kafka, or message files with ``--messages-dir``) ->
    features -> prediction -> sink (console by default), until stopped or,
    with ``--available-now``, until the input present is drained. Rejected
    messages go to ``--rejects-out``. With ``--sink kafka`` both are topics. The checkpoint folder makes a restart
    resume from the last committed offsets."""
    from cabmeter.sources.kafka import kafka_stream, message_file_stream
    from cabmeter.streaming.scoring import start_scoring

    spark = _session()
    model = _load(args)
    if args.messages_dir:
        source = message_file_stream(spark, args.messages_dir)
    else:
        source = kafka_stream(spark, args.bootstrap, args.topic, args.starting_offsets, _options(args))
    # One read of the source; message key, topic, partition and offset ride
    # along with each score.
    sink_options = dict(o.split("=", 1) for o in args.sink_option or [])
    start_scoring(model, source, args.checkpoint, args.out, args.rejects_out, fmt=args.sink,
                  available_now=args.available_now, processing_time=args.trigger,
                  bootstrap=args.sink_bootstrap or args.bootstrap, options=sink_options).awaitTermination()


def publish(args) -> None:
    """Request CSV -> one JSON message per row on the topic."""
    from cabmeter.sources.kafka import publish as publish_messages
    from cabmeter.sources.kafka import to_messages
    from cabmeter.sources.requests import read_requests_csv

    from cabmeter.sources.kafka import write_message_files

    spark = _session()
    messages = to_messages(read_requests_csv(spark, args.requests), topic=args.topic)
    if args.out_dir:
        write_message_files(messages, args.out_dir)
    else:
        publish_messages(messages, args.bootstrap, args.topic, _options(args))


def dashboard(args) -> None:
    """Rides CSV -> the dashboard tables as Parquet under ``--out``."""
    from cabmeter.functions.features import add_ride_features
    from cabmeter.operators import dashboard as d
    from cabmeter.operators.clean import clean_rides
    from cabmeter.sources.rides import read_rides_csv

    spark = _session()
    feats = add_ride_features(clean_rides(read_rides_csv(spark, args.rides)))
    # One read of the rides: one aggregate over all groupings, written once by
    # grouping; the eight tables are made from that.
    for name, df in d.dashboard_tables(d.dashboard_pass(feats, id_col=args.id_col), cap=args.points).items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    spark.read.parquet(f"{args.out}/kpis").show(truncate=False)


def quote(args) -> None:
    """One quote request: distance from the route map, surge suggested from
    the time unless given, then price, base price and price per mile."""
    from cabmeter.functions.surge import fill_suggested_surge
    from cabmeter.operators.model import quote_prices
    from cabmeter.operators.routes import check_quote_requests
    from cabmeter.functions.features import add_ride_features
    from cabmeter.functions.text import currency
    from cabmeter.sources.requests import requests_from_records
    from cabmeter.sources.routes import read_distance_map_csv

    spark = _session()
    rec = dict(cab_type=args.cab_type, name=args.name, source=args.source,
               destination=args.destination, surge_multiplier=args.surge, hour=args.hour,
               day_of_week=args.day, month=args.month)
    reqs = fill_suggested_surge(requests_from_records(spark, [rec]))
    checked = check_quote_requests(reqs, read_distance_map_csv(spark, args.distance_map))
    bad = checked.filter(F.col("reject_reason").isNotNull()).select("reject_reason").collect()
    if bad:
        print(f"Request rejected: {bad[0].reject_reason}")
        sys.exit(2)
    out = quote_prices(_load(args), add_ride_features(checked.drop("reject_reason")))
    out.select("distance", "surge_multiplier",
               *[currency(c).alias(c) for c in ("predicted_price", "base_price", "price_per_mile")]).show()


def scenarios(args) -> None:
    """The eight fare scenarios for one tariff."""
    from cabmeter.operators.scenarios import scenario_display, scenario_prices

    spark = _session()
    t = spark.createDataFrame([(1, float(args.distance), float(args.rate), float(args.fee))],
                              "tariff_id long, distance double, base_rate double, base_fee double")
    (scenario_display(scenario_prices(t)).orderBy("price_rank")
     .select("scenario", "multiplier_text", "estimated_price_text", "savings_text")
     .show(truncate=False))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cabmeter")
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train")
    t.add_argument("--rides", required=True)
    t.add_argument("--model-out", required=True)
    t.add_argument("--id-col", default="ride_id")
    t.add_argument("--infer-schema", action="store_true")
    t.set_defaults(fn=train)

    s = sub.add_parser("score-stream")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap")
    src.add_argument("--messages-dir", help="Parquet message files instead of Kafka")
    s.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    s.add_argument("--topic", default=REQUEST_TOPIC)
    s.add_argument("--model", required=True)
    s.add_argument("--regressor", default=None)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--sink", default="console", choices=["console", "parquet", "kafka"])
    s.add_argument("--out", default=None, help="folder of the scores, or their topic")
    s.add_argument("--rejects-out", default=None, help="folder of the rejects, or their topic")
    s.add_argument("--sink-bootstrap", default=None, help="servers of the kafka sink, if not those of --bootstrap")
    s.add_argument("--sink-option", action="append", metavar="KEY=VALUE", help="writer option of the sink")
    s.add_argument("--trigger", default=None)
    s.add_argument("--option", action="append", metavar="KEY=VALUE",
                   help="Kafka source option, such as maxOffsetsPerTrigger=1000 or kafka.security.protocol=SSL")
    s.set_defaults(fn=score_stream)

    pb = sub.add_parser("publish")
    pb.add_argument("--requests", required=True)
    dst = pb.add_mutually_exclusive_group(required=True)
    dst.add_argument("--bootstrap")
    dst.add_argument("--out-dir", help="write Parquet message files instead of Kafka")
    pb.add_argument("--topic", default=REQUEST_TOPIC)
    pb.add_argument("--option", action="append", metavar="KEY=VALUE", help="Kafka sink option")
    pb.set_defaults(fn=publish)

    d = sub.add_parser("dashboard")
    d.add_argument("--rides", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--id-col", default="ride_id")
    d.add_argument("--points", type=int, default=None, help="at most so many rows of the distance/price sample")
    d.set_defaults(fn=dashboard)

    q = sub.add_parser("quote")
    q.add_argument("--model", required=True)
    q.add_argument("--regressor", default=None)
    q.add_argument("--distance-map", required=True)
    for name in ("cab-type", "name", "source", "destination"):
        q.add_argument(f"--{name}", required=True)
    q.add_argument("--hour", type=int, required=True)
    q.add_argument("--day", type=int, required=True)
    q.add_argument("--month", type=int, required=True)
    q.add_argument("--surge", type=float, default=None)
    q.set_defaults(fn=quote)

    sc = sub.add_parser("scenarios")
    sc.add_argument("--distance", type=float, default=10.0)
    sc.add_argument("--rate", type=float, default=2.5)
    sc.add_argument("--fee", type=float, default=5.0)
    sc.set_defaults(fn=scenarios)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
