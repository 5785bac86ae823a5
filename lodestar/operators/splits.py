"""Holdout, sampling, k-fold and leave-n-out splits; union and complement.

(R1, R2, R4, R5, U1, U2, W4.)

All splits are *labelling* passes: one narrow projection adds the split
column, so "test" and "base" come from a single scan and together partition the
input exactly (no loss, no overlap).  Randomness comes from a hash of the row
key and an explicit seed, so the result does not change when the input is
repartitioned -- unlike ``randomSplit``, which depends on partition layout.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import ship_package


def _key_string(key_cols) -> Column:
    if isinstance(key_cols, str):
        key_cols = [key_cols]
    return F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols])


def hash_bucket(key_cols, buckets: int = 100, seed: int | None = None,
                method: str = "md5") -> Column:
    """A stable bucket ``0..buckets-1`` of the row key.

    ``"md5"`` (default): ``conv(substr(md5(key), 1, 8), 16, 10) % buckets``,
    reproducible in any engine with ``md5`` (the SQL oracles use it).
    ``"xxhash64"``: Spark's 64-bit hash of the key columns -- several times
    cheaper per row, for jobs that need no cross-engine reproduction.
    With a seed the key is prefixed by ``"<seed>:"`` (md5) or the seed is
    hashed in (xxhash64)."""
    if method == "xxhash64":
        cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
        h = F.xxhash64(F.lit(seed if seed is not None else 0), *[F.col(c) for c in cols])
        return F.pmod(h, F.lit(buckets)).cast("int")
    if method != "md5":
        raise ValueError("method must be 'md5' or 'xxhash64'")
    s = _key_string(key_cols)
    if seed is not None:
        s = F.concat_ws(":", F.lit(str(seed)), s)
    h = F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")


def holdout_label(df: DataFrame, key_cols, train_pct: int = 80, seed: int | None = None,
                  col: str = "split", method: str = "md5") -> DataFrame:
    """Label each row ``train`` or ``test`` by key hash."""
    b = hash_bucket(key_cols, 100, seed, method)
    return df.withColumn(col, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("test")))


def holdout_split(df: DataFrame, key_cols, train_pct: int = 80,
                  seed: int | None = None, method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash (R1).  Both halves are filters over the same
    deterministic expression."""
    b = hash_bucket(key_cols, 100, seed, method)
    return df.where(b < train_pct), df.where(b >= train_pct)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """``randomSplit`` for parity with the reference (R1).  Not stable under
    repartitioning; prefer :func:`holdout_split`."""
    return df.randomSplit(list(weights), seed)


def split_counts(labelled: DataFrame, col: str = "split") -> DataFrame:
    """Row count per split (A1): one aggregate, partial counts per task."""
    return labelled.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def sample_k(df: DataFrame, key_col: str, k: int, seed: int = 1) -> DataFrame:
    """``k`` rows without replacement, reproducibly (R2): order by
    ``md5("<seed>:<key>")`` then key, keep ``k``.  Planned as a top-k merge
    (``TakeOrderedAndProject``): k rows per task, no global sort."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key_col).limit(k).drop("_h")


# ------------------------------------------------------------------ positions


def with_dense_position(df: DataFrame, order_cols, pos_col: str = "pos") -> DataFrame:
    """Add a dense 0-based position in ``order_cols`` order without a global
    window.

    The frame is range-sorted and checkpointed (to the shared checkpoint
    folder, so the partition layout is fixed even if executors are lost).  One
    small job counts rows per partition; the per-partition offsets (one row per
    partition) are broadcast and added to the row index inside the partition
    taken from ``monotonically_increasing_id``.
    """
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    sorted_df = df.sort(*order_cols).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = sorted_df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", mid)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a global window over at most #partitions rows
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return out.withColumn(pos_col, (F.col("_off") + local).cast("bigint")).drop("_pid", "_mid", "_off")


def dense_range(df: DataFrame, pos_col: str) -> tuple[int, int]:
    """(lowest position, number of rows); raises unless the positions are
    ``lo .. lo + n - 1``, each once.  No shuffle of rows: two hash sums over
    the positions must equal those over the range."""
    def sums(col):
        return [F.expr(f"bit_xor(xxhash64({col}, {s}L))").alias(f"h{s}") for s in (1, 2)]

    got = df.select(F.col(pos_col).cast("bigint").alias("p")).agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.count("p").alias("n"),
        F.count(F.lit(1)).alias("rows"), *sums("p")).first()
    if not got["rows"]:
        return 0, 0
    if got["n"] == got["rows"] == got["hi"] - got["lo"] + 1:
        want = df.sparkSession.range(got["lo"], got["hi"] + 1).agg(*sums("id")).first()
        if (got["h1"], got["h2"]) == (want["h1"], want["h2"]):
            return got["lo"], got["n"]
    raise ValueError(f"{pos_col} is not a dense position: {got['rows']} rows in {got['lo']}..{got['hi']}")


def kfold_by_position(df: DataFrame, pos_col: str, k: int = 5, n: int | None = None,
                      col: str = "fold") -> DataFrame:
    """Fold of every row for contiguous k-fold (R4): ``(pos * k) div n``,
    ``pos`` 0-based and dense.  Fold i is the test block of round i; the rest is
    its base.  One narrow projection after an aggregate that also checks that
    the positions have no gaps and no repeats; a caller who gives ``n``
    vouches for positions ``0 .. n-1``."""
    if n is None:
        lo, n = dense_range(df, pos_col)
    else:
        lo = 0
    # exact integer arithmetic: (pos - lo) * k div n
    block = F.expr(f"((`{pos_col}` - {lo}) * {int(k)}) div {max(1, int(n))}")
    return df.withColumn(col, block.cast("int"))


def kfold_round(labelled: DataFrame, i: int, col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(base, test) of round ``i``: test = block i, base = every other block."""
    return labelled.where(F.col(col) != i), labelled.where(F.col(col) == i)


def kth_smallest(df: DataFrame, col: str, k: int, buckets: int = 1000) -> int | None:
    """The ``k``-th smallest value of a unique integer column (None if there
    are fewer rows): histograms of ``buckets`` counts, each inside the bucket
    the last one pointed to.  No task or driver sees more than the counts."""
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    if k < 1 or row["n"] < k:
        return None
    lo, hi = int(row["lo"]), int(row["hi"])
    while hi > lo:
        width = -(-(hi - lo + 1) // buckets)
        inside = df.where(F.col(col).between(lo, hi))
        counts = {r["b"]: r["n"] for r in inside.groupBy(F.expr(f"(`{col}` - {lo}) div {width}").alias("b"))
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        for b in sorted(counts):
            if k <= counts[b]:
                break
            k -= counts[b]
        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
    return lo


def leave_n_out_positions(df: DataFrame, user_col: str, pos_col: str, start: int, stop: int,
                          max_test: int = 0) -> DataFrame:
    """``pos_col`` of the leave-n-out test rows (see :func:`leave_n_out`)."""
    w = Window.partitionBy(user_col).orderBy(pos_col)
    first = (df.select(user_col, pos_col)
             .withColumn("_occ", F.row_number().over(w))
             .where(F.col("_occ") <= stop))
    cand = first.where(F.col("_occ") >= start).select(pos_col)
    if max_test and max_test > 0:
        cand = cand.checkpoint()  # read once per histogram
        cut = kth_smallest(cand, pos_col, max_test)
        if cut is not None:
            cand = cand.where(F.col(pos_col) <= cut)
    return cand


def leave_n_out(df: DataFrame, user_col: str, pos_col: str, start: int, stop: int,
                max_test: int = 0, col: str = "split") -> DataFrame:
    """Leave-n-out per user (R5): a user's occurrences ``start..stop`` (1-based,
    in ``pos_col`` order) are test rows, everything else is base.  With
    ``max_test > 0`` only the first ``max_test`` candidates in ``pos_col`` order
    become test rows (the reference's global cap in file order).

    Skew: the per-user window is only asked for the first ``stop`` rows, which
    Spark plans as a ``WindowGroupLimit`` before the shuffle -- a user holding a
    third of all rows ships at most ``stop`` rows per map task.  The cap is a
    filter by the cut position, found by histograms.  The candidates are then
    attached to all rows by an equi-join on the unique position.
    """
    cand = leave_n_out_positions(df, user_col, pos_col, start, stop, max_test).select(
        F.col(pos_col).alias("_tp"))
    out = df.join(cand, F.col(pos_col) == F.col("_tp"), "left")
    return out.withColumn(col, F.when(F.col("_tp").isNotNull(), F.lit("test"))
                          .otherwise(F.lit("base"))).drop("_tp")


def union_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Bag union of row blocks by column name."""
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out


def complement(all_rows: DataFrame, test: DataFrame, keys) -> DataFrame:
    """Rows of ``all_rows`` whose key is not in ``test`` (U2): a left-anti
    join."""
    if isinstance(keys, str):
        keys = [keys]
    return all_rows.join(test.select(*keys), list(keys), "left_anti")


#: copies of one row that a task writes
COPIES_PER_TASK = 1_000_000


def bag_complement(all_rows: DataFrame, test: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """The rows of ``all_rows`` less those of ``test``, as bags (U2): a row that
    stands m times in the one and n times in the other stays max(m - n, 0)
    times; nulls equal nulls.  One aggregate sums +1 and -1 per row (copies are
    pre-aggregated in the tasks that read them), and what is left is
    replicated; a row left more than ``copies_per_task`` times is first dealt
    in portions."""
    columns = list(all_rows.columns)
    if sorted(columns) != sorted(test.columns):
        raise ValueError(f"columns differ: {columns} and {test.columns}")
    left = "left"
    while left in columns:
        left = "_" + left
    signed = all_rows.withColumn(left, F.lit(1)).unionByName(test.withColumn(left, F.lit(-1)))
    kept = signed.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum(left).alias(left)).where(F.col(left) > 0)
    n, size = F.col(left), F.lit(copies_per_task).cast("long")
    few = kept.where(n <= size)
    portion = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / size)), lambda i: F.least(size, n - i * size))
    many = kept.where(n > size).withColumn(left, F.explode(portion)).repartition(
        int(all_rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return few.unionByName(many).withColumn(left, F.explode(F.sequence(F.lit(1).cast("long"), n))).drop(left)


def files_out_of_order(files: DataFrame, sort_cols: Sequence[str]) -> DataFrame:
    """(rows, out_of_order) of a frame read from files: how many rows stand
    before their predecessor in the same file.  The tasks that read the files
    compare neighbours and hand on the two ends of each batch; a window per
    file over these compares the rows that batches part."""
    ship_package(files.sparkSession)
    keys = [f"k{i}" for i in range(len(sort_cols))]
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
                        *[F.col(c).alias(k) for c, k in zip(sort_cols, keys, strict=True)])
    ends = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in keys])
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()), T.StructField("first", ends),
                           T.StructField("last", ends), T.StructField("n", T.LongType()), T.StructField("bad", T.LongType())])
    runs = rows.mapInArrow(_runs_of_rows(keys), schema)
    w = Window.partitionBy("file").orderBy("start")
    parted = (F.lag("last").over(w) > F.col("first")).cast("bigint")
    return runs.select("n", (F.col("bad") + F.coalesce(parted, F.lit(0))).alias("bad")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("out_of_order"))


def _above(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where ``a`` is greater than, and equal to, ``b`` in Spark's order: null
    first, NaN last and equal to itself."""
    if pa.types.is_boolean(a.type):
        a, b = a.cast(pa.int8()), b.cast(pa.int8())
    flags = lambda x: np.asarray(pc.fill_null(x, False).to_numpy(zero_copy_only=False), dtype=bool)
    greater, equal = flags(pc.greater(a, b)), flags(pc.equal(a, b))
    no_a, no_b = flags(pc.is_null(a)), flags(pc.is_null(b))
    if pa.types.is_floating(a.type):
        nan_a, nan_b = flags(pc.is_nan(a)), flags(pc.is_nan(b))
        greater, equal = greater | nan_a & ~nan_b & ~no_b, equal | nan_a & nan_b
    return greater | ~no_a & no_b, equal | no_a & no_b


def _runs_of_rows(keys: Sequence[str]):
    """One row per run of consecutive rows of a file in a batch: its ends, its
    length, and its rows that stand before their predecessor."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            file, row = batch.column("file"), batch.column("row").to_numpy()
            other, _ = _above(file[:-1], file[1:])
            less, _ = _above(file[1:], file[:-1])
            begin = np.concatenate([[0], np.flatnonzero(other | less | (row[1:] != row[:-1] + 1)) + 1])
            end = np.append(begin[1:], len(row))
            bad, same = np.zeros(len(row) - 1, bool), np.ones(len(row) - 1, bool)
            for k in keys:
                column = batch.column(k)
                greater, equal = _above(column[:-1], column[1:])
                bad, same = bad | same & greater, same & equal
            counted = np.concatenate([[0], np.cumsum(bad)])  # of the rows up to each
            ends = [pa.StructArray.from_arrays([batch.column(k).take(pa.array(at)) for k in keys], names=list(keys)) for at in (begin, end - 1)]
            yield pa.RecordBatch.from_arrays([file.take(pa.array(begin)), pa.array(row[begin]), *ends, pa.array(end - begin),
                                              pa.array(counted[end - 1] - counted[begin])],
                                             names=["file", "start", "first", "last", "n", "bad"])
    return run


def write_split_files(labelled: DataFrame, path: str, split_col: str,
                      sort_cols: Sequence[str] = ("user", "item"), mode: str = "errorifexists") -> None:
    """Write a labelled split as one directory per split value, rows sorted by
    ``sort_cols`` (W4 and the split files of U1/U2).

    A range partitioning on (split, sort keys) keeps every task's share
    balanced -- a split holding a fifth of all rows is spread over many tasks
    rather than written by one -- and the files of a split directory hold
    consecutive key ranges, sorted inside.  The number of partitions is left
    to adaptive execution."""
    keys = [split_col, *sort_cols]
    (labelled.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode(mode).partitionBy(split_col).parquet(path))
