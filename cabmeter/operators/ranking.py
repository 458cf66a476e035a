"""Exact ranks within groups, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.session import fresh_dir


def range_ranks(df: DataFrame, group: str, order: Sequence[str], rank: str = "rank") -> DataFrame:
    """``df`` with the place of each row (from 0) within its ``group``, in
    ascending ``order`` (nulls first). Rows that agree in all of ``order`` get
    different places in no stated order.

    The rows are dealt by range of (group, order) and sorted where they are, so
    a group of any size is spread over many tasks. A place is the row's number
    in its task, less that of the first row of its group there, plus the rows
    of the group in earlier tasks; of those only one count per task and group
    is moved. The sorted rows are written once to the shared folder, so their
    numbers stay as they are whatever is lost or read again.
    """
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, "ranks")
    (df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
     .withColumn("__row", F.monotonically_increasing_id()).write.parquet(path))
    laid = spark.read.parquet(path).withColumn("__task", F.shiftright("__row", 33))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = laid.groupBy(group, "__task").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n")).select(
        F.col(group).alias("__group"), F.col("__task").alias("__at"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    joined = laid.join(runs, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__task") == F.col("__at")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__row") + F.col("__shift")).alias(rank))
