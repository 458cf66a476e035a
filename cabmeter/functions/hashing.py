"""Layout-independent sampling and splitting keys.

Seeded ``sample`` and ``randomSplit`` change with the partitioning of their
input; a hash of the row id does not, and gives the same rows on every
engine that has MD5. ``salt`` names the purpose, so that a sample and a split
of the same rows are independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.columns import as_column


def hash32(row_id: Column | str, seed: int, salt: str = "") -> Column:
    """First 32 bits of md5("<salt><seed>:<id>") as a non-negative bigint."""
    text = F.concat(F.lit(f"{salt}{seed}:"), F.coalesce(as_column(row_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(row_id: Column | str, seed: int, buckets: int = 100, salt: str = "") -> Column:
    """0 .. buckets-1, uniform over ids."""
    return hash32(row_id, seed, salt) % F.lit(buckets)


def row_key(df: DataFrame, id_col: str | None) -> Column:
    """The sampling / split key: ``id_col`` as text, or where the table has
    none or it is null a 64-bit hash of the whole row (equal rows then fall on
    the same side)."""
    whole = F.concat(F.lit("row "), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    if id_col and id_col in df.columns:
        return F.coalesce(F.col(id_col).cast("string"), whole)
    return whole
