"""K1 + K5: decode request messages and split them into scored and rejected
by one predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.schemas import REQUEST

PASSTHROUGH = ("key", "topic", "partition", "offset")
NUMERIC_FIELDS = [f.name for f in REQUEST.fields if f.dataType.typeName() in ("double", "integer")]


def decode_requests(messages: DataFrame, passthrough=PASSTHROUGH) -> DataFrame:
    """P3 + F10 + P4: ``CAST(value AS STRING)``, ``from_json`` with the fixed
    request schema, then the struct's fields as columns. A field that does
    not match its type (text for a number, ``5.0`` for an integer) becomes
    null; extra fields are ignored. ``value_text`` and the Kafka metadata
    columns are kept for the reject output.

    The parsed record is expanded with ``inline`` (a generator producing
    exactly one row per message), so the JSON is parsed once per message:
    filters on the fields stay above the generator instead of being pushed
    below it as one re-parse per referenced field."""
    keep = [c for c in passthrough if c in messages.columns]
    text = messages.select(*keep, F.col("value").cast("string").alias("value_text"))
    record = F.array(F.from_json("value_text", REQUEST))
    return text.select(*keep, "value_text", F.inline(record))


def reject_reason() -> Column:
    """K5: why a decoded message cannot be scored, or null. A message is
    rejected exactly when the model's assembler would skip it: a numeric
    field is null or NaN. Text that is not a JSON object is ``malformed_json``,
    an object without any readable field of a request ``empty_record``; the
    second look at the text is only taken where no field was read."""
    reason = F.when(F.col("value_text").isNull(), F.lit("null_value"))
    all_null = None
    for f in REQUEST.fields:
        term = F.col(f.name).isNull()
        all_null = term if all_null is None else all_null & term
    no_object = F.expr("json_object_keys(value_text)").isNull()
    reason = reason.when(all_null & no_object, F.lit("malformed_json")).when(all_null, F.lit("empty_record"))
    for name in NUMERIC_FIELDS:
        c = F.col(name)
        bad = c.isNull() | (F.isnan(c) if name in ("distance", "surge_multiplier") else F.lit(False))
        reason = reason.when(bad, F.lit(f"invalid_{name}"))
    return reason


def split_requests(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scored and rejected parts; together they partition the input."""
    flagged = decoded.withColumn("reject_reason", reject_reason())
    ok = flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = flagged.filter(F.col("reject_reason").isNotNull())
    return ok, bad
