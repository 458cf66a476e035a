"""Dimensions derived from facts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialized_dimension(dim: DataFrame) -> DataFrame:
    """Write a dimension that is derived from the fact data (an aggregate such
    as the route map) once as a Parquet table under the shared folder and read
    it back. That cuts its lineage, survives executor loss and gives the
    planner file sizes, from which ``spark.sql.autoBroadcastJoinThreshold``
    decides by bytes whether the join is a broadcast; beyond it the planner
    sorts and merges, and AQE splits hot keys."""
    from cabmeter.session import fresh_dir

    spark = dim.sparkSession
    path = fresh_dir(spark, "dimensions")
    dim.write.parquet(path)
    return spark.read.schema(dim.schema).parquet(path)
