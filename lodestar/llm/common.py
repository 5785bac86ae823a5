"""Small Spark helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import scratch_path, ship_package
from lodestar.sources.tables import table as read_table

#: rows and bytes of text that a Python worker is sent at a time: its memory,
#: and the JVM's beside the heap, stay small however long the texts are
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, name).select(*columns)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to a new folder under the shared scratch folder and read
    back: the lineage ends there, and lost executors do not lose it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sorted_groups(batches, names: tuple[str, ...]):
    """Tables of consecutive rows with equal (integer) ``names``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(keys[a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def is_held_out(column: str, modulus: int, remainder: int):
    """crc32(id as text) mod ``modulus`` = ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
