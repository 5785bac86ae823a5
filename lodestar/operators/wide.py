"""Moments and least squares of many columns.

``gram_tiled``: the columns are cut into tiles.  A task holds ``CHUNK_CELLS``
numbers of its rows, multiplies one pair of tiles at a time and hands the
product on; the products of a pair meet in one task, which adds them up as they
stream in.  Neither side holds more than a chunk and a tile, and the result
stays a frame, a row per tile pair: nothing of size d^2 is in one place.

``ols_qr``: least squares from a tall-skinny QR.  Every task keeps the R factor
of its rows of [X | y] (d + 1 rows), folding chunks in as they come; R factors
are merged ``FAN_IN`` at a time in a tree.  The condition number of X is not
squared, as it is by the normal equations.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import check_vectors
from lodestar.operators.regression import CollinearError
from lodestar.operators.stats import complete_rows
from lodestar.operators.units import matrix
from lodestar.session import ship_package, written

TILE = 256
CHUNK_CELLS = 1 << 22
FAN_IN = 8


def _chunks(batches, read, d: int, cells: int):
    """Row blocks of at most ``cells`` numbers."""
    most = max(1, cells // max(d, 1))
    held, n = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, most):
            x = read(batch.slice(first, min(most, batch.num_rows - first)))
            if n + len(x) > most:
                yield np.concatenate(held)
                held, n = [], 0
            held.append(x)
            n += len(x)
    if n:
        yield np.concatenate(held)


def gram_tiled(df: DataFrame, vec: str, tile: int = TILE, d: int | None = None, na: str = "error",
               chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """``XᵀX`` of a vector column as ``(tile_i, tile_j, values, n)`` for tile_i
    <= tile_j: ``values`` is the tile's rows back to back, ``n`` the rows of X."""
    checked, d = check_vectors(df.select(F.col(vec).cast("array<double>").alias(vec)), vec, d, na)
    ship_package(df.sparkSession)
    edges = [(a, min(a + tile, d)) for a in range(0, d, tile)]

    def multiply(batches):
        for x in _chunks(batches, lambda b: matrix(b.column(0), d), d, chunk_cells):
            for i, (a, b) in enumerate(edges):
                for j in range(i, len(edges)):
                    part = x[:, a:b].T @ x[:, edges[j][0]:edges[j][1]]
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()),
                                                      pa.array([part.tobytes()], pa.binary()), pa.array([len(x)], pa.int64())],
                                                     names=["tile_i", "tile_j", "part", "n"])

    def add_up(batches):
        key, total, rows = None, None, 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                               pa.array([total], pa.list_(pa.float64())), pa.array([rows], pa.int64())],
                                              names=["tile_i", "tile_j", "values", "n"])
        for batch in batches:
            for i, j, part, n in zip(*(batch.column(c) for c in ("tile_i", "tile_j", "part", "n")), strict=True):
                own = (i.as_py(), j.as_py())
                if own != key:
                    if key is not None:
                        yield done()
                    key, total, rows = own, np.zeros(len(part.as_py()) // 8), 0
                total += np.frombuffer(part.as_py())
                rows += n.as_py()
        if key is not None:
            yield done()

    parts = checked.mapInArrow(multiply, "tile_i int, tile_j int, part binary, n long")
    return parts.repartition("tile_i", "tile_j").sortWithinPartitions("tile_i", "tile_j").mapInArrow(
        add_up, "tile_i int, tile_j int, values array<double>, n long")


def gram_entries(tiles: DataFrame, d: int, tile: int = TILE) -> DataFrame:
    """``(i, j, value)`` for i <= j from the frame of :func:`gram_tiled`."""
    width = F.least(F.lit(tile), F.lit(d) - F.col("tile_j") * tile)
    at = tiles.select("tile_i", "tile_j", width.alias("w"), F.posexplode("values").alias("p", "value"))
    i = F.col("tile_i") * tile + F.floor(F.col("p") / F.col("w"))
    j = F.col("tile_j") * tile + F.col("p") % F.col("w")
    return at.select(i.cast("long").alias("i"), j.cast("long").alias("j"), "value").where("i <= j")


def _r_of(x: np.ndarray) -> np.ndarray:
    """R of a QR, padded to a square, with a non-negative diagonal."""
    r = np.linalg.qr(x, mode="r")
    out = np.zeros((x.shape[1], x.shape[1]))
    out[:len(r)] = r
    return out * np.where(np.diag(out) < 0, -1.0, 1.0)[:, None]


def r_factor(rows: DataFrame, columns: Sequence[str], chunk_cells: int = CHUNK_CELLS, fan_in: int = FAN_IN) -> np.ndarray | None:
    """R of the QR of ``columns`` (doubles without null) over all rows: d x d
    numbers on the driver; None without rows."""
    d = len(columns)
    spark = rows.sparkSession
    ship_package(spark)

    def factor(batches):
        r = None
        for x in _chunks(batches, lambda b: np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1), d, chunk_cells):
            r = _r_of(x if r is None else np.concatenate([r, x]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def merge(batches):
        node, r = None, None
        for batch in batches:
            for own, part in zip(batch.column("node").to_pylist(), batch.column("r").to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])
                    node, r = own, None
                x = np.frombuffer(part).reshape(d, d)
                r = x if r is None else _r_of(np.concatenate([r, x]))
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def numbered(df):
        # the task that wrote a factor is its leaf, or node, of the tree
        return written(df.withColumn("at", F.monotonically_increasing_id()), "r-factors")

    factors = numbered(rows.select(*columns).mapInArrow(factor, "r binary"))
    while (n := factors.count()) > 1:
        node = F.floor(F.shiftright("at", 33) / fan_in)
        dealt = factors.select(node.alias("node"), "at", "r").repartition(-(-n // fan_in), "node")
        factors = numbered(dealt.sortWithinPartitions("node", "at").mapInArrow(merge, "r binary"))
    row = factors.select("r").first()
    return None if row is None else np.frombuffer(row["r"]).reshape(d, d)


def ols_qr(df: DataFrame, features: Sequence[str], target: str, na: str = "error", fan_in: int = FAN_IN) -> dict[str, float]:
    """Least-squares coefficients by name, and under ``None`` the residual sum
    of squares.  Columns that others determine, within rounding, raise
    :class:`~lodestar.operators.regression.CollinearError`."""
    columns = [*features, target]
    r = r_factor(complete_rows(df, columns, na), columns, fan_in=fan_in)
    if r is None:
        raise ValueError("no rows")
    d = len(features)
    # what a column adds to those before it, against its own length
    own, norm = np.abs(np.diag(r))[:d], np.linalg.norm(r[:, :d], axis=0)
    weak = [c for c, a, n in zip(features, own, norm, strict=True) if a <= n * d * 1e-14]
    if weak:
        raise CollinearError(f"X has not full rank; dependent columns: {weak}")
    w = np.zeros(d)
    for i in range(d - 1, -1, -1):
        w[i] = (r[i, d] - r[i, i + 1:d] @ w[i + 1:]) / r[i, i]
    return {**dict(zip(features, map(float, w), strict=True)), None: float(r[d, d] ** 2)}
