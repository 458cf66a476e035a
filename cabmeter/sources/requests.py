"""Ride requests: CSV scan (S4), loosely typed records (S8; in memory or a
table) and requests derived from rides."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabmeter.functions.features import add_calendar
from cabmeter.sources.layout import read_csv_by_name
from cabmeter.schemas import REQUEST

REQUEST_FIELDS = [f.name for f in REQUEST.fields]


def read_requests_csv(spark: SparkSession, path: str, mixed_headers: bool = False) -> DataFrame:
    """Request CSV with a header line, typed by column name."""
    return read_csv_by_name(spark, path, REQUEST, mixed_headers)


def _coerce(value, dtype):
    if value is None:
        return None
    if isinstance(dtype, T.DoubleType):
        return float(value)
    if isinstance(dtype, T.IntegerType):
        return int(value)
    return str(value)


# A decimal number as text; other spellings (``NaN``, ``1_000``, ``0x1F``) are none.
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INT_LIMIT = 2.0 ** 31


def _number(column: Column, given: T.DataType) -> Column:
    """A loosely typed value as a double; null if it is no number."""
    if isinstance(given, T.StringType):
        text = F.regexp_replace(column, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if isinstance(given, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    return F.lit(None).cast("double")


def coerced(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A loosely typed value as a request field's type, by the rules of a form:
    a number may be given as text with blanks around it, as any numeric type or
    as a boolean; a whole-number field cuts a fraction off; anything becomes
    text. Null if the value is null, is text that is no number, or does not fit
    the type (a NaN or a number beyond an int for a whole-number field)."""
    if isinstance(wanted, T.StringType):
        return column.cast("string")
    number = _number(column, given)
    if isinstance(wanted, T.IntegerType):
        # Doubles hold every int exactly.
        return F.when(~F.isnan(number) & (F.abs(number) < _INT_LIMIT), number.cast("int"))
    return number


def coerce_requests(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """S8 over a table of loosely typed records of any size: the ``keep``
    columns, the request fields with the types of the request schema (see
    ``coerced``), and ``bad_fields``, the names of the fields whose value could
    not be read, in schema order, separated by commas (null if there is none).

    A field that the records lack is null and no bad field; other columns are
    left out. One projection: no shuffle, and nothing goes through the driver.
    """
    given = {f.name: f.dataType for f in records.schema.fields}
    fields = {f.name: coerced(F.col(f"`{f.name}`"), given[f.name], f.dataType) if f.name in given
              else F.lit(None).cast(f.dataType) for f in REQUEST.fields}
    bad = [F.when(F.col(f"`{name}`").isNotNull() & value.isNull(), F.lit(name))
           for name, value in fields.items() if name in given]
    return records.select(*keep, *[v.alias(n) for n, v in fields.items()],
                          F.nullif(F.concat_ws(",", *bad), F.lit("")).alias("bad_fields"))


def requests_from_records(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """A request table from in-memory records (for example a quote form),
    with numbers coerced to the request schema's float / int types."""
    rows = [tuple(_coerce(r.get(f.name), f.dataType) for f in REQUEST.fields) for r in records]
    return spark.createDataFrame(rows, REQUEST)


def requests_from_rides(rides: DataFrame, key_col: str = "ride_id") -> DataFrame:
    """One request per ride: the ride's fields plus its calendar fields, keyed
    by ``key_col``."""
    return add_calendar(rides).select(
        key_col, *[F.col(f.name).cast(f.dataType) for f in REQUEST.fields]
    )
