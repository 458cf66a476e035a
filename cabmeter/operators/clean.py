"""Keep rides with a positive price and a positive distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_rides(df: DataFrame, drop_nan: bool = False) -> DataFrame:
    """``price IS NOT NULL AND price > 0 AND distance > 0``; a null distance is
    dropped as well. Spark orders NaN above every number, so a NaN price or
    distance passes ``> 0``; ``drop_nan=True`` removes those rows too. The
    predicate reaches the Parquet scan as pushed filters when the input is a
    plain scan."""
    cond = F.col("price").isNotNull() & (F.col("price") > 0) & (F.col("distance") > 0)
    if drop_nan:
        cond = cond & ~F.isnan("price") & ~F.isnan("distance")
    return df.filter(cond)
