"""S3: route distance map CSV (source, destination, max_distance)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabmeter.operators.routes import normalize_distance_map
from cabmeter.schemas import DISTANCE_MAP
from cabmeter.sources.layout import read_csv_by_name


def read_distance_map_csv(spark: SparkSession, path: str, mixed_headers: bool = False) -> DataFrame:
    """The map with both keys trimmed and lower-cased (F5) and unique per
    directed route (the larger distance wins on a duplicate key)."""
    raw = read_csv_by_name(spark, path, DISTANCE_MAP, mixed_headers)
    return normalize_distance_map(raw)
