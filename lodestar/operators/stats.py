"""One-pass moments, correlation, error metrics and accuracy.

(A1, A4-A9, A12, M23.)

Every statistic here is a single global or keyed aggregate: tasks compute
partial sums, one final merge combines d or d^2 numbers.  The reference's
"constant key -> one reducer" pattern and its one-job-per-correlation loop
both disappear.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import check_vectors

# Up to this many columns the Gram matrix is one aggregate of d(d+1)/2
# codegen'd sums; above it, per-partition numpy partials are summed instead.
# Rows with a null or NaN are settled before either (``complete_rows``).
UNROLLED_GRAM_MAX_COLS = 24


def complete_rows(df: DataFrame, cols: Sequence[str], na: str = "error") -> DataFrame:
    """``cols`` of ``df`` as doubles.  A row with a null or NaN in one of them
    fails the job (``na="error"``) or is left out whole (``"drop"``)."""
    out = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull() | F.isnan(c)
    if na == "drop":
        return out.where(~bad)
    if na != "error":
        raise ValueError("na must be 'error' or 'drop'")
    return out.where(F.when(bad, F.raise_error(F.lit("null or NaN in the input"))).otherwise(F.lit(True)))


def _cross_products(d: int, read, centre=None):
    """A task's partial sums: ``XᵀX`` of its rows (less ``centre``) as
    (i, j, v, n) rows."""
    def run(batches):
        acc = np.zeros((d, d))
        n = 0
        for batch in batches:
            x = read(batch)
            if centre is not None:
                x = x - centre
            acc += x.T @ x
            n += len(x)
        i, j = np.indices((d, d), dtype=np.int32)
        # plain Arrow arrays: a NaN stays a NaN and cannot vanish as a null
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(acc.ravel()),
             pa.array(np.full(d * d, n, dtype=np.int64))], names=["i", "j", "v", "n"])
    return run


def corr_with_target(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every feature with the target (A6), in one
    aggregate, returned long: ``(feature, corr)``.  A pair with a null side is
    left out of that feature's correlation."""
    wide = df.agg(*[F.corr(target, c).alias(c) for c in features])
    stack = ", ".join(f"'{c}', `{c}`" for c in features)
    return wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, corr)")


def select_by_correlation(df: DataFrame, target: str, features: Sequence[str],
                          threshold: float = 0.5, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Keep the features whose ``|corr|`` with the target is at least
    ``threshold`` (M23).  Only d correlations reach the driver.  Returns the
    projected frame (``keep`` columns, the selected features, the target) and the
    selected names."""
    corr = {r["feature"]: r["corr"] for r in corr_with_target(df, target, features).collect()}
    chosen = [c for c in features if corr[c] is not None and abs(corr[c]) >= threshold]
    return df.select(*keep, *chosen, target), chosen


def _gram_unrolled(df: DataFrame, cols: Sequence[str], target: str | None):
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"g__{a}__{b}"))
        if target:
            aggs.append(F.sum(F.col(a) * F.col(target)).alias(f"t__{a}"))
    aggs.append(F.count(F.lit(1)).alias("_n"))
    row = df.agg(*aggs).first()
    d = len(cols)
    g = np.zeros((d, d))
    for i, a in enumerate(cols):
        for j in range(i, d):
            g[i, j] = g[j, i] = row[f"g__{a}__{cols[j]}"]
    t = np.array([row[f"t__{a}"] for a in cols]) if target else None
    return g, t, int(row["_n"])


def _gram_partials(df: DataFrame, cols: Sequence[str], target: str | None):
    """Blocked form for wide inputs: each task multiplies its Arrow batches
    (numpy ``XᵀX``) and emits d^2 partial sums; Spark sums them by (i, j).
    The driver receives d^2 numbers."""
    d = len(cols)
    names = list(cols) + ([target] if target else [])

    def read(batch):
        return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)

    parts = (df.select(*names).mapInArrow(_cross_products(len(names), read), "i int, j int, v double, n long")
             .groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")))
    m = np.zeros((len(names), len(names)))
    n = 0
    for r in parts.collect():
        m[r["i"], r["j"]] = r["v"]
        n = int(r["n"])
    g = m[:d, :d]
    t = m[:d, d] if target else None
    return g, t, n


def gram(df: DataFrame, cols: Sequence[str], target: str | None = None, na: str = "error"):
    """``XᵀX`` (A4) and ``Xᵀy`` (A5) in one pass; returns numpy arrays and the
    row count.  The result is d x d, bounded by the number of columns.  Rows
    with a null or NaN are an error or dropped whole, whatever the width."""
    df = complete_rows(df, [*cols, *([target] if target else [])], na)
    if len(cols) <= UNROLLED_GRAM_MAX_COLS:
        return _gram_unrolled(df, cols, target)
    return _gram_partials(df, cols, target)


def gram_long(df: DataFrame, cols: Sequence[str], target: str | None = None, na: str = "error") -> DataFrame:
    """``XᵀX`` and ``Xᵀy`` as a long frame ``(row_name, col_name, value)``:
    upper triangle of XᵀX plus one row per feature against the target.
    A single aggregate; the stack happens on the one-row result.  Rows with a
    null or NaN are an error or dropped whole, as in :func:`gram`."""
    df = complete_rows(df, [*cols, *([target] if target else [])], na)
    aggs, labels = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"g{len(labels)}"))
            labels.append((a, b))
        if target:
            aggs.append(F.sum(F.col(a) * F.col(target)).alias(f"g{len(labels)}"))
            labels.append((a, target))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', g{k}" for k, (a, b) in enumerate(labels))
    return wide.selectExpr(f"stack({len(labels)}, {stack}) AS (row_name, col_name, value)")


def mse_rmse(pairs: DataFrame, truth: str, pred: str) -> DataFrame:
    """Mean squared error and its root (A7, F10) in one aggregate; a pair with a
    null side is in neither the mean nor ``n``."""
    e = F.col(truth).cast("double") - F.col(pred).cast("double")
    mse = F.avg(e * e)
    return pairs.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.count(e).cast("bigint").alias("n"))


def accuracy(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Multi-class accuracy (A8): mean of ``prediction == label``, the same
    number ``MulticlassClassificationEvaluator(metricName="accuracy")`` gives,
    but as a DataFrame aggregate."""
    hit = (F.col(pred).cast("double") == F.col(label).cast("double")).cast("double")
    return scored.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).cast("bigint").alias("n"))


def count_per_key(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key (A12 batch form): partial counts before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def vector_mean(df: DataFrame, vec: str) -> tuple[np.ndarray, int]:
    """(mean vector, rows) of an ``ARRAY<DOUBLE>`` column: one aggregate
    buffer of d numbers per task for any d."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    s = Summarizer.metrics("mean", "count").summary(array_to_vector(F.col(vec)))
    row = df.select(s.alias("s")).select(vector_to_array("s.mean").alias("mean"), "s.count").first()
    return np.array(row["mean"], dtype=np.float64), int(row["count"])


def covariance_long(df: DataFrame, vec: str, d: int | None = None, na: str = "error") -> DataFrame:
    """Sample covariance of the coordinates of a vector column as
    ``(i, j, cov)`` for all i, j (M19's input).

    Two passes: means (d numbers to the driver), then per-partition numpy
    partials of the centred cross products, summed by (i, j) in Spark.  The
    driver never holds more than d^2 numbers; nothing is collected per row.
    Every vector is checked (``functions.vectors.check_vectors``).
    """
    df, d = check_vectors(df.select(F.col(vec).cast("array<double>").alias("v")), "v", d, na)
    mu, n = vector_mean(df, "v")

    def read(batch):
        return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)

    sums = (df.mapInArrow(_cross_products(d, read, mu), "i int, j int, v double, n long")
            .groupBy("i", "j").agg(F.sum("v").alias("s")))
    return sums.select("i", "j", (F.col("s") / F.lit(n - 1)).alias("cov"))


def covariance_matrix(df: DataFrame, vec: str) -> np.ndarray:
    """:func:`covariance_long` as a d x d array."""
    rows = covariance_long(df, vec).collect()
    out = np.zeros((1 + max(r["i"] for r in rows),) * 2)
    for r in rows:
        out[r["i"], r["j"]] = r["cov"]
    return out
