"""Partition layout helpers for iterative jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame


ROWS_PER_PARTITION = 20_000


def dealt_by_key(df: DataFrame, key_cols, rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """``df`` dealt by hash of its key into sorted partitions of about
    ``rows_per_partition`` rows.  The layout follows from the data and the
    number of ``rows`` alone -- not from files or cores -- so seeded sampling
    per partition gives the same result on any cluster, and an iterative fit
    on a few large files still has many tasks."""
    if isinstance(key_cols, str):
        key_cols = [key_cols]
    return df.repartition(max(1, -(-rows // rows_per_partition)), *key_cols).sortWithinPartitions(*key_cols)
