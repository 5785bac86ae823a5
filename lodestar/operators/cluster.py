"""Clustering: centroids, nearest-centre assignment, Lloyd k-means, MLlib
k-means, cost, and distance-ranked members per cluster.

(M16-M18, J6, A2, A3, A11, W1.)

Scale notes
-----------
* Centres are K x d numbers.  They live on the driver between iterations and
  enter the plan as array literals, so each iteration's plan has constant
  depth, the same shape every time (no re-compilation), and the assignment is
  a narrow projection (no join, no broadcast).
* The per-cluster means are one ``groupBy(cluster)`` aggregate: partial
  aggregation leaves at most K rows per map task, so a cluster that holds a
  third of all points costs nothing extra.
* The input is persisted once (MEMORY_AND_DISK) for the iterations and
  unpersisted in ``finally``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import (check_vectors, distance_array, euclidean_distance, first_argmin,
                                        squared_distance)
from lodestar.operators.lookup import checked_broadcast
from lodestar.operators.partitioning import ROWS_PER_PARTITION, dealt_by_key
from lodestar.operators.topk import top_n_per_group
from lodestar.operators.units import matrix
from lodestar.session import ship_package


def group_centroids(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Mean vector per key (A2): ``(key, n, centre ARRAY<DOUBLE>)`` of checked
    vectors.  One aggregate whose tasks ship a buffer of d numbers per key."""
    m = _cluster_means(df, vec, key)
    return m.select(key, "n", F.col("mean").alias("centre"))


def rank_by_centre_distance(df: DataFrame, key: str, id_col: str, vec: str, n: int,
                            d: int | None = None, salts: int = 16, max_groups: int = 10_000) -> DataFrame:
    """Rows nearest to their group's mean, top ``n`` per group (W1 + A2 + F6).

    Output ``(cluster_id, item_id, ranking_score, rank)``; ties by id.  Up to
    ``max_groups`` centres are fetched (groups x d numbers) and broadcast as a
    local table; more are shuffle-joined.  The top-n windows run a per-task
    ``WindowGroupLimit`` before their shuffle, in ``salts`` parts per group
    first.
    """
    df, d = check_vectors(df, vec, d)
    centres = group_centroids(df, key, vec).select(F.col(key).alias("_ck"), "centre")
    rows = centres.limit(max_groups + 1).collect()
    if len(rows) <= max_groups:
        centres = checked_broadcast(df.sparkSession.createDataFrame(rows, centres.schema))
    scored = (df.join(centres, F.col(key) == F.col("_ck"))
              .select(F.col(key).alias("cluster_id"), F.col(id_col).alias("item_id"),
                      euclidean_distance(vec, "centre", d).alias("ranking_score")))
    return top_n_per_group(scored, "cluster_id", ["ranking_score", "item_id"], n, salts=salts)


# --------------------------------------------------------------------------- Lloyd


@dataclass
class LloydResult:
    centres: list[list[float]]            # K x d, index = cluster id
    shifts: list[float] = field(default_factory=list)   # A11 per iteration
    iterations: int = 0
    converged: bool = False


def init_centres(df: DataFrame, id_col: str, vec: str, k: int, init: str = "first",
                 seed: int = 1) -> list[list[float]]:
    """k initial centres: the ``k`` lowest ids (``"first"``) or a seeded
    sample without replacement (``"sample"``, R2).  Only k rows reach the
    driver (top-k merge)."""
    from lodestar.operators.splits import sample_k
    if init == "first":
        rows = df.orderBy(id_col).limit(k).select(vec).collect()
    elif init == "sample":
        rows = sample_k(df, id_col, k, seed).select(vec).collect()
    else:
        raise ValueError("init must be 'first' or 'sample'")
    return [list(map(float, r[0])) for r in rows]


def assign_nearest(df: DataFrame, vec: str, centres, d: int,
                   cluster_col: str = "cluster_id", dist_col: str | None = None,
                   unroll: bool = False) -> DataFrame:
    """Nearest centre per row, ties to the lowest index (J6, F9).  A narrow
    projection: centres are literals, no join.

    By default each centre is one array literal and the distance is a
    ``zip_with``/``aggregate`` expression: the plan text is identical from one
    Lloyd iteration to the next, so nothing is re-generated or re-compiled per
    iteration.  ``unroll=True`` writes every term out (fully codegen'd, but new
    code for every new set of centres)."""
    if unroll:
        dists = distance_array(vec, centres, d)
    else:
        dists = F.array(*[squared_distance(vec, [float(x) for x in c]) for c in centres])
    out = df.withColumn("_dists", dists)
    out = out.withColumn(cluster_col, first_argmin("_dists"))
    if dist_col:
        out = out.withColumn(dist_col, F.array_min("_dists"))
    return out.drop("_dists")


def _cluster_means(assigned: DataFrame, vec: str, cluster_col: str) -> DataFrame:
    """Per-cluster mean vector and count in one aggregate (A2): Spark ML's
    ``Summarizer`` merges partial per-task buffers, so each task ships at most
    K rows."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    s = (assigned.select(cluster_col, array_to_vector(F.col(vec)).alias("_v"))
         .groupBy(cluster_col).agg(Summarizer.metrics("mean", "count").summary(F.col("_v")).alias("_s")))
    return s.select(cluster_col, vector_to_array("_s.mean").alias("mean"), F.col("_s.count").alias("n"))


class NotConvergedError(RuntimeError):
    pass


def lloyd_kmeans(df: DataFrame, vec: str, k: int, id_col: str = "id", max_iter: int = 100,
                 tol: float = 1e-4, init: str = "first", seed: int = 1, centres=None,
                 fixed_iterations: int | None = None, na: str = "error",
                 rows_per_partition: int = ROWS_PER_PARTITION) -> LloydResult:
    """Lloyd's k-means as repeated (assign, per-cluster sum) jobs.

    * at least one iteration always runs (7.4#1); a loop that has not
      converged after ``max_iter`` raises :class:`NotConvergedError` (7.4#2);
      ``fixed_iterations`` runs exactly that many and says in ``converged``
      whether the last shift passed the test;
    * an empty cluster keeps its centre; ties go to the lowest index (7.4#3);
    * the stop test is the reference's: sum over non-empty clusters of the
      squared centre shift, compared with ``tol`` (A11).
    """
    checked, d = check_vectors(df.select(id_col, vec), vec, None, na)
    data = dealt_by_key(checked, id_col, df.count(), rows_per_partition).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cur = [list(c) for c in centres] if centres is not None else init_centres(
            data, id_col, vec, k, init, seed)
        if len(cur) < k:
            k = len(cur)           # fewer points than K: one centre per point
        res = LloydResult(centres=cur)
        limit = fixed_iterations if fixed_iterations is not None else max_iter
        for it in range(max(1, limit)):
            means = _cluster_means(assign_nearest(data, vec, cur, d, "_c"), vec, "_c").collect()
            new = [list(c) for c in cur]
            shift = 0.0
            for r in means:             # at most K rows
                c, m = r["_c"], list(r["mean"])
                shift += sum((a - b) ** 2 for a, b in zip(cur[c], m))
                new[c] = m
            cur = new
            res.shifts.append(shift)
            res.iterations = it + 1
            res.converged = shift <= tol
            if fixed_iterations is None and res.converged:
                break
        res.centres = cur
        if fixed_iterations is None and not res.converged:
            raise NotConvergedError(f"shift {res.shifts[-1]:g} > {tol:g} after {res.iterations} iterations")
        return res
    finally:
        data.unpersist()


@dataclass
class BoundedResult(LloydResult):
    distances: int = 0    # worked out
    possible: int = 0     # points x centres x iterations

    @property
    def skipped_share(self) -> float:
        return 1 - self.distances / self.possible if self.possible else 0.0


CHECKPOINT_EVERY = 8
#: numbers in a block of differences
BLOCK_CELLS = 1 << 21
#: bounds decide only by more than what rounding can do to them
BOUND_MARGIN = 1e-9


def _bounded_step(centres: np.ndarray, drift: np.ndarray | None, d: int):
    """One assignment of (id, vector, cluster, upper, lower, worked): a point's
    distance to its centre is at most ``upper``, to any other at least
    ``lower``; ``drift`` is how far each centre has moved since."""
    k = len(centres)
    apart = np.full(k, np.inf)
    if k > 1:
        between = np.sqrt(((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
        np.fill_diagonal(between, np.inf)
        apart = between.min(axis=1) / 2
    others = np.zeros(k)  # the farthest move among the other centres
    if drift is not None and k > 1:
        top = np.argsort(-drift)
        others[:] = drift[top[0]]
        others[top[0]] = drift[top[1]]

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1), d)
            n = len(x)
            cluster, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4))
            worked = np.zeros(n, dtype=np.int64)
            todo = np.arange(n)
            if drift is not None:
                upper += drift[cluster]
                lower -= others[cluster]
                sure = np.maximum(lower, apart[cluster]) * (1 - BOUND_MARGIN)
                todo = np.flatnonzero(upper >= sure)
                upper[todo] = np.sqrt(((x[todo] - centres[cluster[todo]]) ** 2).sum(axis=1))
                worked[todo] = 1
                todo = todo[upper[todo] >= sure[todo]]
            rows = max(1, BLOCK_CELLS // (k * d))
            for first in range(0, len(todo), rows):
                own = todo[first:first + rows]
                squared = ((x[own][:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
                nearest = squared.argmin(axis=1)  # ties: the lowest index
                cluster[own], upper[own] = nearest, np.sqrt(squared[np.arange(len(own)), nearest])
                squared[np.arange(len(own)), nearest] = np.inf
                lower[own] = np.sqrt(squared.min(axis=1))
                worked[own] = k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(v) for v in (cluster, upper, lower, worked))],
                names=batch.schema.names)
    return run


def kmeans_bounded(df: DataFrame, vec: str, k: int, id_col: str = "id", max_iter: int = 100, tol: float = 1e-4,
                   init: str = "first", seed: int = 1, centres=None, fixed_iterations: int | None = None,
                   na: str = "error", rows_per_partition: int = ROWS_PER_PARTITION) -> BoundedResult:
    """:func:`lloyd_kmeans` for many centres: the same centres with fewer
    distances (M18, J6).

    Every point carries its cluster, an upper bound of its distance to that
    centre and a lower bound of that to all others from one iteration to the
    next; the centres' moves widen them.  While the bounds decide, no distance
    is worked out; else first the one to the own centre, then all.  The centres
    go to the tasks as one array.  The points with their bounds are kept
    (MEMORY_AND_DISK), those of the iteration before are released, and every
    ``CHECKPOINT_EVERY`` iterations they are written to the shared folder."""
    spark = df.sparkSession
    ship_package(spark)
    checked, d = check_vectors(df.select(id_col, F.col(vec).cast("array<double>").alias(vec)), vec, None, na)
    dealt = dealt_by_key(checked, id_col, df.count(), rows_per_partition)
    kind = dealt.schema[id_col].dataType.simpleString()
    state = dealt.withColumns({"_c": F.lit(0), "_upper": F.lit(0.0), "_lower": F.lit(0.0), "_worked": F.lit(0).cast("long")}).persist(
        StorageLevel.MEMORY_AND_DISK)
    kept = [state]
    try:
        cur = [list(c) for c in centres] if centres is not None else init_centres(state, id_col, vec, k, init, seed)
        res = BoundedResult(centres=cur)
        n, drift = state.count(), None
        limit = fixed_iterations if fixed_iterations is not None else max_iter
        for it in range(max(1, limit)):
            step = _bounded_step(np.array(cur, dtype=float).reshape(len(cur), d), drift, d)
            state = state.mapInArrow(step, f"`{id_col}` {kind}, `{vec}` array<double>, _c int, _upper double, _lower double, _worked long")
            if it % CHECKPOINT_EVERY == CHECKPOINT_EVERY - 1:
                state = state.checkpoint()
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(state)
            means = _cluster_means(state, vec, "_c").collect()  # at most K rows
            res.distances += state.agg(F.sum("_worked")).first()[0] or 0
            res.possible += n * len(cur)
            kept.pop(0).unpersist()
            new = [list(c) for c in cur]
            for r in means:
                new[r["_c"]] = list(r["mean"])
            moved = np.array(new, dtype=float).reshape(len(cur), d) - np.array(cur, dtype=float).reshape(len(cur), d)
            drift = np.sqrt((moved**2).sum(axis=1)) * (1 + BOUND_MARGIN)
            cur = new
            res.shifts.append(float((moved**2).sum()))
            res.iterations = it + 1
            res.converged = res.shifts[-1] <= tol
            if fixed_iterations is None and res.converged:
                break
        res.centres = cur
        if fixed_iterations is None and not res.converged:
            raise NotConvergedError(f"shift {res.shifts[-1]:g} > {tol:g} after {res.iterations} iterations")
        return res
    finally:
        for df in kept:
            df.unpersist()


def centres_frame(spark, centres) -> DataFrame:
    """Centres as a long-form frame ``(cluster_id, dim, value)``: K x d rows."""
    rows = [(int(c), int(i), float(v)) for c, cen in enumerate(centres) for i, v in enumerate(cen)]
    return spark.createDataFrame(rows, "cluster_id int, dim int, value double")


def clustering_cost(df: DataFrame, vec: str, centres, d: int) -> DataFrame:
    """Sum of distances and of squared distances to the nearest centre (A3).

    The reference's "within set sum of squared errors" adds *unsquared*
    distances (7.4#5); both sums are returned."""
    a = assign_nearest(df, vec, centres, d, "_c", "_sq")
    return a.agg(F.sum(F.sqrt("_sq")).alias("sum_distance"),
                 F.sum("_sq").alias("sum_squared_distance"))


# --------------------------------------------------------------------------- MLlib


def mllib_kmeans(df: DataFrame, vec: str, id_col: str, k: int, seed: int, max_iter: int = 10,
                 init_mode: str = "k-means||", tol: float = 1e-4, restarts: int = 1,
                 rows_per_partition: int = ROWS_PER_PARTITION):
    """Spark ML k-means (M16, R3) on an ``ARRAY<DOUBLE>`` column.  The seed is
    mandatory (7.4#15).  With ``restarts > 1`` the fit is repeated with seeds
    ``seed, seed+1, ...`` and the model with the lowest training cost is kept
    (k-means only finds a local optimum).  Initial sampling goes by partition,
    so the fit reads a layout that follows from ``id_col``, the row count and
    ``rows_per_partition`` alone.  Returns the model and the frame it predicts
    on: ``df`` with the vector column ``_vec``, not persisted."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    df, _ = check_vectors(df, vec)
    feats = df.withColumn("_vec", array_to_vector(F.col(vec)))
    data = dealt_by_key(feats.select(id_col, "_vec"), id_col, df.count(), rows_per_partition).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        best, cost = None, None
        for r in range(max(1, restarts)):
            km = KMeans(k=k, maxIter=max_iter, initMode=init_mode, tol=tol, seed=seed + r,
                        featuresCol="_vec", predictionCol="prediction")
            model = km.fit(data)
            if best is None or model.summary.trainingCost < cost:
                best, cost = model, model.summary.trainingCost
        return best, feats
    finally:
        data.unpersist()


def centre_distance(vec_col: str, centres, cluster_col: str) -> "F.Column":
    """Euclidean distance from a row to its own assigned centre (M17 centre
    lookup + F6).  The K x d centres are one array literal indexed by the
    cluster column, so the expression has the same size for any K."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in cen]) for cen in centres])
    own = F.element_at(table, F.col(cluster_col).cast("int") + 1)
    return euclidean_distance(vec_col, own)


__all__ = [
    "BoundedResult", "LloydResult", "NotConvergedError", "assign_nearest", "centre_distance", "centres_frame",
    "clustering_cost", "group_centroids", "init_centres", "kmeans_bounded", "lloyd_kmeans", "mllib_kmeans",
    "rank_by_centre_distance", "squared_distance",
]
