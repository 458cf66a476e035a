"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cabmeter.session import fresh_dir


def cut(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared folder and read
    it back: the lineage ends there, a lost executor costs nothing that was
    written, and later steps read the columns they need. The table stays until
    the folder of the run is removed; use it for narrow tables."""
    path = fresh_dir(df.sparkSession, f"llm/{kind}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
