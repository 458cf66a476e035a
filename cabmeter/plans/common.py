"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabmeter.functions.features import add_ride_features
from cabmeter.operators.clean import clean_rides
from cabmeter.session import fresh_dir
from cabmeter.sources.rides import rides_from_tables

DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column, so results compare across engines whose
    summation order differs."""
    cols = [
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def stored(df: DataFrame) -> DataFrame:
    """Write rows that a query passes over many times once as Parquet under
    the shared folder and read them back, so that no pass derives them anew.
    They are dealt evenly over the session's shuffle partitions: the later
    passes use all cores, however few splits the source has."""
    spark = df.sparkSession
    path = fresh_dir(spark, "rows")
    df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rides:
    """The rides of one query, derived once: ``all`` (every ride), ``clean``
    (P1) and ``featured`` (clean + calendar + P7-P10). The three frames share
    one scan lineage, so a query using two of them plans the derivation and
    its dimension check once. With ``store_clean`` the clean rides are written
    once and read back (see ``stored``), for a query of many passes."""

    def __init__(self, spark: SparkSession, sf_dir: str, store_clean: bool = False):
        self.all = rides_from_tables(spark, sf_dir)
        self.clean = clean_rides(self.all)
        if store_clean:
            self.clean = stored(self.clean)
        self.featured = add_ride_features(self.clean)
