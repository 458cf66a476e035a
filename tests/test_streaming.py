import json

import pytest
from pyspark.sql import functions as F

from cabmeter.sources.kafka import to_messages
from cabmeter.streaming.decode import decode_requests, split_requests

VALID = dict(cab_type="Uber", name="UberX", source="North End", destination="South Station", distance=3.25,
             surge_multiplier=1.25, hour=8, day_of_week=2, month=6)


def _msg(i, text):
    return (str(i).encode(), None if text is None else text.encode())


def _fixtures():
    d = dict(VALID)
    cases = {
        "valid": (json.dumps(d), None),
        "not_json": ("this is not json", "malformed_json"),
        "null_value": (None, "null_value"),
        "empty_object": ("{}", "empty_record"),
        "other_object": (json.dumps({"driver": "x"}), "empty_record"),
        "array": ("[1, 2]", "malformed_json"),
        "cut": (json.dumps(d)[:20], "malformed_json"),
        "missing_number": (json.dumps({k: v for k, v in d.items() if k != "distance"}), "invalid_distance"),
        "int_as_float": (json.dumps({**d, "hour": 5.0}), "invalid_hour"),
        "number_as_string": (json.dumps({**d, "surge_multiplier": "1.5"}), "invalid_surge_multiplier"),
        "extra_field": (json.dumps({**d, "driver": "x"}), None),
        "nan_token": (json.dumps(d).replace("3.25", "NaN"), "invalid_distance"),
        "unknown_place": (json.dumps({**d, "source": "MIT"}), None),
        "missing_string": (json.dumps({k: v for k, v in d.items() if k != "name"}), None),
    }
    return cases


def test_malformed_messages_are_split(spark):
    cases = _fixtures()
    rows = [_msg(name, text) for name, (text, _) in cases.items()]
    msgs = spark.createDataFrame(rows, "key binary, value binary")
    ok, bad = split_requests(decode_requests(msgs))
    got_ok = {r.key.decode() for r in ok.collect()}
    got_bad = {r.key.decode(): r.reject_reason for r in bad.collect()}
    assert got_ok == {n for n, (_, reason) in cases.items() if reason is None}
    assert got_bad == {n: reason for n, (_, reason) in cases.items() if reason is not None}
    assert len(got_ok) + len(got_bad) == len(cases)


def test_message_round_trip(spark):
    from cabmeter.sources.requests import requests_from_records

    reqs = requests_from_records(spark, [VALID]).withColumn("ride_id", F.lit(7))
    msgs = to_messages(reqs, key_col="ride_id")
    row = msgs.first()
    assert json.loads(row.value.decode()) == VALID and row.key == b"7" and row.topic == "cab_price_features"
    back = decode_requests(msgs).first()
    assert back.distance == 3.25 and back.hour == 8 and back.name == "UberX"


def test_kafka_source_requires_connector(spark):
    from cabmeter.sources.kafka import kafka_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9092")


def test_stream_restart_resumes_from_checkpoint(spark):
    """A second run on the same checkpoint picks up only the new messages,
    so each message is scored exactly once across restarts."""
    from cabmeter.functions.features import add_ride_features
    from cabmeter.session import fresh_dir
    from cabmeter.sources.kafka import message_file_stream, write_message_files
    from cabmeter.streaming.scoring import run_to_table

    base = fresh_dir(spark, "streams")

    def batch(ids):
        rows = [(i, *VALID.values()) for i in ids]
        ddl = ("ride_id long, cab_type string, name string, source string, destination string, "
               "distance double, surge_multiplier double, hour int, day_of_week int, month int")
        return to_messages(spark.createDataFrame(rows, ddl).coalesce(1), key_col="ride_id")

    def run():
        ok, _ = split_requests(decode_requests(message_file_stream(spark, f"{base}/in")))
        return run_to_table(add_ride_features(ok), f"{base}/out", f"{base}/ck")

    write_message_files(batch([1, 2, 3]), f"{base}/in")
    first = sorted(r.key.decode() for r in run().collect())
    write_message_files(batch([4, 5]), f"{base}/in")
    second = sorted(r.key.decode() for r in run().collect())
    assert first == ["1", "2", "3"]
    assert second == ["1", "2", "3", "4", "5"]


def test_console_sink(spark):
    from cabmeter.session import fresh_dir
    from cabmeter.sources.kafka import message_file_stream, write_message_files
    from cabmeter.sources.requests import requests_from_records
    from cabmeter.streaming.scoring import start_sink

    base = fresh_dir(spark, "streams")
    write_message_files(to_messages(requests_from_records(spark, [VALID])), f"{base}/in")
    ok, _ = split_requests(decode_requests(message_file_stream(spark, f"{base}/in")))
    q = start_sink(ok.select("cab_type", "name", "distance"), None, f"{base}/ck", fmt="console")
    q.awaitTermination()
    # The JVM prints the batch to its own stdout; check the query's progress.
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_stream_without_messages_gives_an_empty_table(spark):
    import os

    from cabmeter.session import fresh_dir
    from cabmeter.sources.kafka import message_file_stream
    from cabmeter.streaming.scoring import run_to_table

    base = fresh_dir(spark, "streams")
    os.makedirs(f"{base}/in")
    ok, _ = split_requests(decode_requests(message_file_stream(spark, f"{base}/in")))
    out = run_to_table(ok, f"{base}/out", f"{base}/ck")
    assert out.count() == 0 and "distance" in out.columns


class _Recorder:
    """Stands where a reader or writer stands and keeps what it is told."""

    def __init__(self):
        self.told, self.kind, self.done = {}, None, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **more):
        self.told.update(more)
        return self

    def load(self):
        self.done = "load"
        return self

    def save(self):
        self.done = "save"


def test_kafka_options_reach_reader_and_writer():
    """S5 and S6 without a broker: the options that Spark would be given."""
    from types import SimpleNamespace

    from cabmeter.sources import kafka

    reader = _Recorder()
    kafka.kafka_stream(SimpleNamespace(readStream=reader), "h:9092", "t", "earliest",
                       {"maxOffsetsPerTrigger": "500", "failOnDataLoss": "false", "kafka.security.protocol": "SSL"})
    assert reader.kind == "kafka" and reader.done == "load"
    assert reader.told == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
                           "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false", "kafka.security.protocol": "SSL"}
    writer = _Recorder()
    kafka.publish(SimpleNamespace(select=lambda *c: SimpleNamespace(write=writer)), "h:9092", "t",
                  {"kafka.retries": "9"})
    assert writer.kind == "kafka" and writer.done == "save"
    assert writer.told["topic"] == "t" and writer.told["kafka.retries"] == "9"
    assert writer.told["kafka.enable.idempotence"] == "true"


def test_cli_passes_kafka_options(monkeypatch):
    from cabmeter import cli
    from cabmeter.sources import kafka, requests

    seen = {}
    monkeypatch.setattr(cli, "_session", lambda: None)
    monkeypatch.setattr(requests, "read_requests_csv", lambda *a: None)
    monkeypatch.setattr(kafka, "to_messages", lambda *a, **b: "messages")
    monkeypatch.setattr(kafka, "publish", lambda *a: seen.update(args=a))
    cli.main(["publish", "--requests", "x", "--bootstrap", "h:1", "--option", "kafka.security.protocol=SSL",
              "--option", "kafka.ssl.key.password=a=b"])
    assert seen["args"] == ("messages", "h:1", "cab_price_features",
                            {"kafka.security.protocol": "SSL", "kafka.ssl.key.password": "a=b"})
