"""CSV headers read by kilobytes, the Kafka sink, failures between two sinks,
and the dashboard from one pass."""

import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cabmeter.operators import dashboard as d
from cabmeter.session import fresh_dir
from cabmeter.sources.layout import file_headers, read_csv_by_name
from cabmeter.schemas import REQUEST
from tests.test_streaming import VALID


def _bytes_read(spark):
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in stats)


def test_headers_take_kilobytes_of_large_files(spark):
    folder = tempfile.mkdtemp(prefix="cabmeter headers-")
    for i in range(3):
        with open(f"{folder}/f {i}.csv", "w") as f:
            f.write("\n  \n" if i == 1 else "")
            f.write(f"distance,hour,x{i % 2}\n" + "1.5,7,abcdefgh\n" * 500_000)
    open(f"{folder}/empty.csv", "w").close()
    with gzip.open(f"{folder}/z.csv.gz", "wt") as f:
        f.write("hour,distance\n" + "8,2.5\n" * 100_000)
    before = _bytes_read(spark)
    got = {os.path.basename(f): h for f, h in file_headers(spark, folder)}
    assert got == {"f 0.csv": "distance,hour,x0", "f 1.csv": "distance,hour,x1", "f 2.csv": "distance,hour,x0",
                   "empty.csv": None, "z.csv.gz": "hour,distance"}
    assert _bytes_read(spark) - before < 5 * 200_000 < os.path.getsize(f"{folder}/f 0.csv")
    rows = read_csv_by_name(spark, folder, REQUEST, mixed_headers=True)
    assert rows.agg(F.sum("hour"), F.sum("distance")).first()[:] == (500_000 * 21 + 800_000, 500_000 * 4.5 + 250_000)


class _Recorder:
    """Stands in for a writer to Kafka: keeps options and messages."""

    def __init__(self, monkeypatch):
        self.sent, self.fail = [], 0
        recorder = self

        def save(writer, path=None, format=None, **options):
            found = dict(recorder.options)
            if found.get("__format") != "kafka":
                return recorder.real(writer, path, format, **options)
            if recorder.fail:
                recorder.fail -= 1
                raise RuntimeError("no broker")
            recorder.sent.append((found, writer._df.collect()))

        self.options, self.real = {}, DataFrameWriter.save
        set_format, set_options = DataFrameWriter.format, DataFrameWriter.options

        def note_format(writer, source):
            recorder.options = {"__format": source}
            return writer if source == "kafka" else set_format(writer, source)

        def note_options(writer, **options):
            recorder.options.update(options)
            return writer if recorder.options.get("__format") == "kafka" else set_options(writer, **options)

        monkeypatch.setattr(DataFrameWriter, "format", note_format)
        monkeypatch.setattr(DataFrameWriter, "options", note_options)
        monkeypatch.setattr(DataFrameWriter, "save", save)


@pytest.fixture(scope="module")
def scoring(spark, tmp_path_factory):
    """A fitted model and a folder of messages, every third of them broken."""
    from cabmeter.operators import model as m
    from cabmeter.sources.kafka import to_messages, write_message_files

    ddl = "ride_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REQUEST.fields)
    rows = [(i, *{**VALID, "distance": 1.0 + i, "hour": i % 24}.values()) for i in range(12)]
    requests = spark.createDataFrame(rows, ddl)
    from cabmeter.functions.features import add_ride_features

    model = m.fit_fare_model(add_ride_features(requests).withColumn("price", F.col("distance") * 2))
    messages = to_messages(requests.coalesce(1), key_col="ride_id").withColumn(
        "value", F.when(F.col("key").cast("string").cast("int") % 3 == 0, F.lit(b"oops")).otherwise(F.col("value")))
    folder = str(tmp_path_factory.mktemp("messages"))
    write_message_files(messages, folder)
    return model, folder


def _run(spark, scoring, checkpoint, **more):
    from cabmeter.sources.kafka import message_file_stream
    from cabmeter.streaming.scoring import start_scoring

    q = start_scoring(scoring[0], message_file_stream(spark, scoring[1]), checkpoint, **more)
    q.awaitTermination()
    return q


def _fails(spark, scoring, checkpoint, **more):
    with pytest.raises(Exception, match="no broker|no disk"):
        _run(spark, scoring, checkpoint, **more)


def test_scores_and_rejects_go_to_topics(spark, scoring, monkeypatch):
    recorder = _Recorder(monkeypatch)
    _run(spark, scoring, fresh_dir(spark, "ck"), out="scores", rejects_out="rejects", fmt="kafka", bootstrap="h:1",
         options={"kafka.retries": "9"})
    (scores, good), (rejects, bad) = recorder.sent
    assert scores == {"__format": "kafka", "kafka.bootstrap.servers": "h:1", "topic": "scores", "kafka.retries": "9",
                      "kafka.retry.backoff.ms": "100", "kafka.enable.idempotence": "true"}
    assert rejects["topic"] == "rejects"
    assert sorted(int(r.key) for r in good) == [1, 2, 4, 5, 7, 8, 10, 11] and sorted(int(r.key) for r in bad) == [0, 3, 6, 9]
    value = json.loads(bytes(good[0].value))
    assert set(value) >= {"cab_type", "distance", "predicted_price", "topic"} and isinstance(value["predicted_price"], float)
    assert json.loads(bytes(bad[0].value))["reject_reason"] == "malformed_json"


def test_a_failed_batch_is_sent_again(spark, scoring, monkeypatch):
    """At least once: the restart repeats the whole batch."""
    recorder = _Recorder(monkeypatch)
    checkpoint = fresh_dir(spark, "ck")
    more = dict(out="scores", rejects_out="rejects", fmt="kafka", bootstrap="h:1")
    recorder.fail = 1
    _fails(spark, scoring, checkpoint, **more)
    assert recorder.sent == []
    _run(spark, scoring, checkpoint, **more)
    _run(spark, scoring, checkpoint, **more)  # nothing new
    assert [o["topic"] for o, _ in recorder.sent] == ["scores", "rejects"]
    assert sum(len(rows) for _, rows in recorder.sent) == 12


def test_kafka_sink_needs_a_topic(spark, scoring):
    with pytest.raises(ValueError, match="topic"):
        _run(spark, scoring, fresh_dir(spark, "ck"), out=None, fmt="kafka", bootstrap="h:1")


def test_failure_between_scores_and_rejects_loses_and_repeats_nothing(spark, scoring, monkeypatch):
    base, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "ck")
    real, left = DataFrameWriter.save, [1]

    def save(writer, path=None, *a, **b):
        if path and "/rejects/" in path and left[0]:
            left[0] -= 1
            raise RuntimeError("no disk")
        return real(writer, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "save", save)
    more = dict(out=f"{base}/scores", rejects_out=f"{base}/rejects")
    _fails(spark, scoring, checkpoint, **more)
    assert spark.read.parquet(f"{base}/scores").count() == 8  # written before the failure
    _run(spark, scoring, checkpoint, **more)
    keys = lambda part: sorted(int(r.key) for r in spark.read.parquet(f"{base}/{part}").collect())
    assert keys("scores") == [1, 2, 4, 5, 7, 8, 10, 11] and keys("rejects") == [0, 3, 6, 9]


def test_start_sink_sends_messages(spark, scoring, monkeypatch):
    """The streaming writer gets Kafka's columns and options."""
    from pyspark.sql.streaming import DataStreamWriter

    from cabmeter.sources.kafka import message_file_stream, result_options
    from cabmeter.streaming.decode import decode_requests, split_requests
    from cabmeter.streaming.scoring import start_sink

    seen = {}
    monkeypatch.setattr(DataStreamWriter, "start", lambda w, path=None: seen.update(df=w._df, path=path))
    real = DataStreamWriter.options
    monkeypatch.setattr(DataStreamWriter, "options", lambda w, **o: seen.update(o) or real(w, **o))
    ok, _ = split_requests(decode_requests(message_file_stream(spark, scoring[1])))
    start_sink(ok, None, fresh_dir(spark, "ck"), fmt="kafka", options=result_options("h:1", "t"))
    assert seen["df"].columns == ["key", "value"] and seen["topic"] == "t" and seen["kafka.bootstrap.servers"] == "h:1"


def _close(a, b):
    key = lambda r: repr([round(v, 6) if isinstance(v, float) else v for v in r])
    return a.columns == b.columns and sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_dashboard_pass_gives_the_single_operators_tables(spark, sf_small):
    from cabmeter.plans.common import Rides

    feats = Rides(spark, sf_small).featured
    feats = feats.unionByName(feats.where("ride_id < 200")).withColumn(
        "hour", F.when(F.col("ride_id") % 7 != 0, F.col("hour")))  # repeated rides, a null hour
    hourly, service = d.hourly_stats(feats), d.service_stats(feats)
    want = {"hourly": hourly, "daily": d.daily_stats(feats), "service": service, "top_services": d.top_services(service),
            "surge": d.surge_stats(feats), "kpis": d.dashboard_kpis(hourly), "fare_trend": d.fare_trend(feats)}
    parts = d.dashboard_pass(feats)
    got = d.dashboard_tables(parts)
    assert all(_close(got[k], want[k].select(got[k].columns)) for k in want)
    for cap in (None, 5, 100_000):
        assert _close(d.dashboard_tables(parts, cap=cap)["distance_price"], d.distance_price_sample(feats, cap=cap))
    empty = d.dashboard_tables(d.dashboard_pass(feats.limit(0)))
    assert all(_close(empty[k], v.select(got[k].columns)) for k, v in {
        "hourly": d.hourly_stats(feats.limit(0)), "fare_trend": d.fare_trend(feats.limit(0))}.items())


def test_dashboard_reads_its_rides_once(spark, sf_small):
    """The rides are read by the pass alone: the tables read its result, and
    its plan has one scan."""
    from cabmeter.functions.features import add_ride_features
    from cabmeter.sources.rides import read_rides_csv, rides_from_tables

    folder = fresh_dir(spark, "csv")
    rides_from_tables(spark, sf_small).coalesce(1).write.option("header", True).csv(folder)
    feats = add_ride_features(read_rides_csv(spark, folder))
    before = _bytes_read(spark)
    parts = d.dashboard_pass(feats)
    once = _bytes_read(spark) - before
    size = sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".csv"))
    assert once < 2 * size
    for df in d.dashboard_tables(parts).values():
        assert df.inputFiles() and all("/dashboard/" in f for f in df.inputFiles())
    assert not feats.is_cached
