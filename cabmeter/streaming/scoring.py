"""Streaming features, scoring and output.

``score_requests`` is a plain DataFrame function: the same code scores a
batch request table or a stream. MLlib ``transform`` is a projection plus the
assembler's filter, so it runs inside the micro-batch plan with no state.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabmeter.functions.features import add_ride_features
from cabmeter.session import path_exists
from cabmeter.sources.kafka import result_options, to_result_messages
from cabmeter.streaming.decode import PASSTHROUGH, decode_requests, split_requests

OUTPUT_COLUMNS = ["cab_type", "name", "distance", "surge_multiplier"]


def score_requests(model: PipelineModel, requests: DataFrame, extra=()) -> DataFrame:
    """K2 + K3 + P5: features, prediction, and the output projection."""
    preds = model.transform(add_ride_features(requests))
    keep = [c for c in extra if c in preds.columns]
    return preds.select(*keep, *OUTPUT_COLUMNS, F.col("prediction").alias("predicted_price"))


def start_sink(df: DataFrame, path: str | None, checkpoint: str, fmt: str = "parquet",
               available_now: bool = True, processing_time: str | None = None,
               query_name: str | None = None, options: dict | None = None) -> StreamingQuery:
    """Append output with a checkpoint, so a restarted query resumes
    from its last committed offsets. ``available_now`` drains what is there
    and stops (tests, backfills); otherwise ``processing_time`` sets the
    trigger interval and the query runs until stopped.

    ``options`` go to the writer. With ``fmt="kafka"`` rows are sent as
    messages (see ``to_result_messages``) to the topic that the options name
    (see ``result_options``); a batch that fails midway is sent again after a
    restart, so messages arrive at least once. Files are written exactly once."""
    if fmt == "kafka":
        df = to_result_messages(df)
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.option("truncate", False)
    w = w.options(**(options or {}))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path) if path else w.start()


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drain a stream into Parquet at ``path`` and return it as a table; a
    source without messages gives an empty table."""
    spark: SparkSession = df.sparkSession
    q = start_sink(df, path, checkpoint, fmt="parquet", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if not path_exists(spark, path):
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(path)


def _kafka_topic(rows: DataFrame, bootstrap: str, topic: str, options: dict | None) -> None:
    """Send the rows of one micro-batch to a topic."""
    to_result_messages(rows).write.format("kafka").options(**result_options(bootstrap, topic, options)).save()


def start_scoring(model: PipelineModel, messages: DataFrame, checkpoint: str, out: str | None,
                  rejects_out: str | None = None, fmt: str = "parquet", available_now: bool = True,
                  processing_time: str | None = None, bootstrap: str | None = None,
                  options: dict | None = None) -> StreamingQuery:
    """Scores and rejects from one read of the source: every micro-batch is
    decoded once and persisted while both parts are written.

    Files: each part goes to a folder of its batch id that a retried batch
    overwrites, so a restart neither loses nor repeats a message, also after a
    failure between the two writes. ``kafka``: ``out`` and ``rejects_out`` are
    topics at ``bootstrap``, scores keyed by the request's message key; a
    retried batch is sent again as a whole, so each score and reject arrives at
    least once (its source topic, partition and offset, which are part of the
    message, tell repeats apart). ``console`` prints the scores. ``options``
    go to the writers of scores and rejects."""
    if fmt == "kafka" and not (bootstrap and out):
        raise ValueError("the kafka sink needs the servers (bootstrap) and a topic (out)")
    decoded = decode_requests(messages)

    def put(rows: DataFrame, where: str, batch_id: int, form: str) -> None:
        if fmt == "kafka":
            _kafka_topic(rows, bootstrap, where, options)
        else:
            rows.write.mode("overwrite").format(form).options(**(options or {})).save(f"{where}/batch_id={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok, bad = split_requests(batch)
            scored = score_requests(model, ok, extra=PASSTHROUGH)
            if fmt == "console":
                scored.show(truncate=False)
            else:
                put(scored, out, batch_id, fmt)
            if rejects_out:
                put(bad, rejects_out, batch_id, "parquet")
        finally:
            batch.unpersist()

    w = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
