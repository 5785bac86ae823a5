"""Working relations derived from the driver tables.

The reference's inputs (ratings, item records, numeric points, a regression
table, a labelled classification table) are not shipped; these derivations
stand in for them.  Each is a lazy DataFrame over the parquet scan, so every
query built on them grows with the tables.  The matching DuckDB expressions live
in :mod:`lodestar.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources.tables import table

# Names given to the six flag bits of ``p_size`` (bit 0 first).
GENRE_NAMES = ["Plain", "Brisk", "Sunny", "Woven", "Tall", "Quiet"]
N_FLAGS = len(GENRE_NAMES)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user, item, rating)``: one row per (customer, part) pair that was
    ordered; rating = 1 + max quantity mod 5 (1..5).

    Plan: lineitem ⋈ orders on the order key (sort-merge or AQE broadcast),
    then a partial+final hash aggregate on (user, item).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg((F.lit(1) + F.max("l_quantity").cast("int") % 5).alias("rating"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, title, flags)``: part rows with the six low bits of
    ``p_size`` as a 0/1 flag array (bit 0 first)."""
    p = table(spark, sf_dir, "part")
    flags = F.array(*[F.shiftright(F.col("p_size"), i).bitwiseAND(1) for i in range(N_FLAGS)])
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                    flags.cast("array<int>").alias("flags"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, features ARRAY<DOUBLE>, label)`` from ``embeddings``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


DESIGN_FEATURES = ["l_quantity", "l_discount", "l_tax"]
DESIGN_TARGET = "l_extendedprice"


def design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression table: keys, three features, ``intercept`` = 1 (P5), target."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *DESIGN_FEATURES,
                     F.lit(1.0).alias("intercept"), DESIGN_TARGET)


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification table: two numeric features and a label in {1, 2, 3}.

    label = 2 if discount >= 0.05, else 1 if tax >= 0.04, else 3.
    """
    li = table(spark, sf_dir, "lineitem")
    label = (F.when(F.col("l_discount") >= 0.05, 2)
             .when(F.col("l_tax") >= 0.04, 1).otherwise(3))
    return li.select("l_orderkey", "l_linenumber", "l_discount", "l_tax",
                     label.cast("int").alias("label"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with a dense position (``event_id``)."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
