"""Parquet tables of a data directory (``{sf_dir}/{name}.parquet``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; projection and filters applied later reach the parquet
    reader (column pruning + pushed filters)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
