"""CSV folders read by column name."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(text: Column, dtype: T.DataType) -> Column:
    """A CSV value as ``dtype``; null if it cannot be read as such. A whole
    number may be written as a float (``1544952607890.0``, ``1.5E3``)."""
    if not isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return text.try_cast(dtype)
    as_double = text.try_cast("double")
    whole = F.when((as_double == F.floor(as_double)) & (F.abs(as_double) <= 2.0 ** 53), as_double)
    return F.coalesce(text.try_cast(dtype), whole.try_cast(dtype))


def _raw(spark: SparkSession, files, names: list[str]) -> DataFrame:
    """The files as text columns; a file whose header differs fails the read
    instead of giving its values to the wrong columns."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(files)


def _header(spark: SparkSession, files) -> list[str]:
    return spark.read.option("header", True).csv(files).columns


def file_headers(spark: SparkSession, path: str, threads: int = 16) -> list[tuple[str, str | None]]:
    """(file, header) of every file under ``path``: its first line that is not
    blank, or null if it has none.

    The files are opened through their own file system (and codec) from a few
    threads of the driver, which lists them anyway, and closed after one read
    buffer: some kilobytes a file, whatever its size. A Spark task cannot stop
    there, its reader goes on to the end of the split."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> tuple[str, str | None]:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = where.getFileSystem(conf).open(where)
        try:
            codec = codecs.getCodec(where)
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
                codec.createInputStream(stream) if codec else stream, "UTF-8"))
            line = lines.readLine()
            while line is not None and not line.strip():
                line = lines.readLine()
            return where.toString(), line  # as readers take it, without escapes
        finally:
            stream.close()

    with ThreadPoolExecutor(threads) as pool:
        return sorted(pool.map(first_line, spark.read.text(path).inputFiles()))


def raw_csv(spark: SparkSession, path: str, mixed_headers: bool = False) -> DataFrame:
    """A CSV folder with header lines, every column as text.

    All files must have the same header, else the read fails. With
    ``mixed_headers`` the files may order their columns differently or lack
    some: each file's first line is read (see ``file_headers``), files are
    grouped by header, and the groups are united by name. Only (file, header)
    pairs reach the driver, which lists the files anyway."""
    if not mixed_headers:
        return _raw(spark, path, _header(spark, path))
    groups: dict[str, list[str]] = {}
    for file, header in file_headers(spark, path):
        if header is not None:
            groups.setdefault(header, []).append(file)
    out = None
    for header in sorted(groups):
        files = sorted(groups[header])
        part = _raw(spark, files, _header(spark, files[0]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else _raw(spark, path, _header(spark, path))


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType,
                     mixed_headers: bool = False) -> DataFrame:
    """A CSV folder typed by column *name*: each column named in ``schema``
    gets its type (a value that cannot be read as such becomes null, see
    ``cast_failures``), other columns stay text. No inference pass is made."""
    raw = raw_csv(spark, path, mixed_headers)
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        typed(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns])


def cast_failures(spark: SparkSession, path: str, schema: T.StructType,
                  mixed_headers: bool = False) -> DataFrame:
    """One row: for every typed column, how many non-empty values could not be
    read as its type."""
    raw = raw_csv(spark, path, mixed_headers)
    return raw.agg(*[
        F.count_if(F.col(f"`{f.name}`").isNotNull() & typed(F.col(f"`{f.name}`"), f.dataType).isNull()).alias(f.name)
        for f in schema.fields if f.name in raw.columns])
