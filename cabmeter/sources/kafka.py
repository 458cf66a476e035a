"""Request messages: JSON encoding (F11), publishing (S5), the Kafka stream
source (S6) and a file stand-in with the same columns for offline runs.

The Kafka connector is a separate artifact; the functions that touch it only
build the reader / writer, and fail at ``load`` / ``save`` when the connector
is not on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabmeter.schemas import REQUEST, REQUEST_TOPIC

# The columns of a Kafka source that decoding uses.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# Producer settings of the original publisher, as Kafka client options.
PRODUCER_OPTIONS = {
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "100",
    "kafka.enable.idempotence": "true",
}


def to_messages(requests: DataFrame, key_col: str | None = None,
                topic: str = REQUEST_TOPIC) -> DataFrame:
    """one UTF-8 JSON object per request in ``value``; ``key`` is the
    optional ``key_col`` as text (null otherwise)."""
    fields = [f.name for f in REQUEST.fields]
    key = F.col(key_col).cast("string").cast("binary") if key_col else F.lit(None).cast("binary")
    return requests.select(
        key.alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def publish(messages: DataFrame, bootstrap_servers: str, topic: str = REQUEST_TOPIC,
            options: dict | None = None) -> None:
    """Write the messages to a Kafka topic (batch)."""
    opts = {**PRODUCER_OPTIONS, **(options or {})}
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers)
     .option("topic", topic).options(**opts).save())


def to_result_messages(rows: DataFrame, key_col: str = "key") -> DataFrame:
    """Rows as messages: ``key_col`` (the request's message key, if there is
    one) as the key, all other columns as one JSON object in ``value``. Binary
    columns become text."""
    plain = [F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.BinaryType)
             else F.col(f"`{f.name}`") for f in rows.schema.fields if f.name != key_col]
    key = F.col(key_col).cast("binary") if key_col in rows.columns else F.lit(None).cast("binary")
    return rows.select(key.alias("key"), F.to_json(F.struct(*plain)).cast("binary").alias("value"))


def result_options(bootstrap_servers: str, topic: str, options: dict | None = None) -> dict[str, str]:
    """Writer options of a result topic: the producer settings of
    ``publish``, which ``options`` may replace."""
    return {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **(options or {})}


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = REQUEST_TOPIC,
                 starting_offsets: str = "latest", options: dict | None = None) -> DataFrame:
    """The request topic as a streaming frame (``key``, ``value``,
    ``topic``, ``partition``, ``offset``, ...)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .options(**(options or {}))
            .load())


def write_message_files(messages: DataFrame, path: str) -> None:
    """Offline producer: append messages as Parquet files with the Kafka
    column layout (partition/offset filled from the file's row order are not
    needed, so they stay null)."""
    out = messages.select(
        "key", "value", F.col("topic").cast("string"),
        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"),
    )
    out.write.mode("append").parquet(path)


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Offline stand-in for S6: a streaming Parquet source with the Kafka
    columns."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
