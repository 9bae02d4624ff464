"""A small quality summary of a mart, or of its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a missing key, key combinations, repeated ones, and the largest.

    Counts per key are combined before they shuffle, so a key with very many rows costs no more than
    one with few.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    per_key = mart.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    copies = F.col("copies")
    return per_key.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, copies)), F.lit(0)).alias("null_key_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(copies > 1, 1)).alias("repeated_keys"),
        F.coalesce(F.max(copies), F.lit(0)).alias("largest_key_rows"),
    )
