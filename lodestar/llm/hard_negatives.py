"""Hard negatives by exact integer scores in a residue number system.

An anchor's positives are the ``positives`` best other rows of its label; the
negatives of a positive are the first ``negatives`` rows of another label whose
score lies in a window below the positive's score.  Scores are inner products
of integer vectors; higher ones come first, ties by smaller id.

Scores are computed as matrix products modulo several primes below 256.  The
residues are balanced (-(p-1)/2 .. (p-1)/2), so a product over ``COLUMNS``
columns stays below 2^24 and float32 holds it exactly; wider vectors are summed
piece by piece.  There are as many primes as the greatest possible score needs
(Cauchy: the greatest squared norm of a row), and the signed score is put
together from balanced mixed-radix digits, the constructive form of the Chinese
remainder theorem.

All rows are dealt into groups of at most ``CELLS`` components, the anchors are
sent to every group, and a task holds one group while the anchors stream past
it in tiles.  Each group gives its best ``positives`` (then ``negatives``) rows
per anchor (and positive); a window over these finds the best of all.  Two such
passes are made, since the windows are not known before the positives.

Defined cases: rows with a null label or vector, or with a null, infinite or
NaN component take no part.  Missing components of shorter vectors are 0.
Repeated rows are rows of their own.  Null ids come after all others and are
never anchors.  Scores that could reach 2^63 / 100 raise.  Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: percent of the positive's score, both ends included
WINDOW = (50, 95)

COLUMNS = 1024  # 1024 * 125^2 < 2^24
CELLS = 1 << 22
LEAST_GROUP = 4096
ROW_TILE = 4096
ANCHOR_TILE = 256
LOWEST = np.iinfo(np.int64).min
LAST_ID = np.iinfo(np.int64).max


@functools.lru_cache(maxsize=1)
def small_primes() -> tuple[int, ...]:
    """The odd primes below 256, greatest first."""
    return tuple(n for n in range(255, 2, -2) if all(n % d for d in range(3, n, 2)))


def moduli(bound: int) -> list[int]:
    """The first primes whose product holds every score of -bound .. bound."""
    taken, product = [], 1
    for p in small_primes():
        if product > 2 * bound:
            break
        taken.append(p)
        product *= p
    return taken


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Whole float64 numbers reduced to -(p-1)/2 .. (p-1)/2."""
    return x - p * np.rint(x / p)


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """float32 matrices of balanced residues, one a prime."""
    out = []
    for p in primes:
        r = matrix % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact int64 inner products of all left with all right rows."""
    found = []
    for a, b, p in zip(left, right, primes, strict=True):
        total = np.zeros((len(a), len(b)))
        for first in range(0, a.shape[1], COLUMNS):
            part = slice(first, first + COLUMNS)
            total += balanced((a[:, part] @ b[:, part].T).astype(np.float64), p)
        found.append(total)
    value = np.zeros((len(left[0]), len(right[0])), dtype=np.int64)
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        # what the earlier digits leave, divided by the product of their primes
        rest, place = found[i], 1
        for digit, q in zip(digits, primes, strict=False):
            rest = rest - digit * (place % p)
            place *= q
        digit = balanced(balanced(rest, p) * pow(place, -1, p), p)
        digits.append(digit)
        # places beyond 64 bits wrap, and so does the sum, which fits
        value += digit.astype(np.int64) * np.uint64(place % (1 << 64)).astype(np.int64)
    return value


def first_of_each(row: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` entries of every row: by score downwards,
    then ``order`` upwards."""
    by = np.lexsort((order, -score, row))
    row = row[by]
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    return by[rank < k]


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``k`` allowed entries of every row."""
    if score.shape[1] > k:
        filled = np.where(allowed, score, LOWEST)
        allowed = allowed & (filled >= np.partition(filled, -k, axis=1)[:, -k, None])
    row, column = np.nonzero(allowed)
    kept = first_of_each(row, score[row, column], column, k)
    return row[kept], column[kept]


def matrix_of(column, width: int) -> np.ndarray:
    """(rows x width) int64 of a list column; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width), dtype=np.int64)
    size = np.diff(column.offsets.to_numpy())
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Group:
    """The rows of a group in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, primes: list[int]):
        t = pa.Table.from_batches(batches)
        ids = t.column("id").combine_chunks()
        rows = t.column("row").to_numpy()
        by = np.lexsort((rows, ids.fill_null(LAST_ID).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        self.ids, self.rows = ids.take(pa.array(by)), rows[by]
        self.labels = t.column("label").to_numpy()[by]
        self.residues = residues(matrix_of(t.column("v"), width)[by], primes)

    def tiles(self):
        for first in range(0, len(self.rows), ROW_TILE):
            part = slice(first, first + ROW_TILE)
            yield first, self.rows[part], self.labels[part], [r[part] for r in self.residues]


def _against_all(find, names: list[str], k: int, width: int, primes: list[int]):
    """Streams rows sorted by group, a group's rows (turn 0) before the anchors
    (turn 1).  ``find`` yields (anchor and positive number, row, column) of a
    tile's best; ``k`` of them a number and group are given out."""
    def run(batches):
        group, held, number = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("group", "turn")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if keys[a][0] != number:
                    group, held, number = None, [], keys[a][0]
                if keys[a][1] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if group is None and held:
                    group, held = Group(held, width, primes), []
                if group is None:
                    continue
                for first in range(a, b, ANCHOR_TILE):
                    tile = batch.slice(first, min(b - first, ANCHOR_TILE))
                    yield from _tile(tile, group, find, names, k, width, primes)
    return run


def _tile(tile: pa.RecordBatch, group: Group, find, names, k, width, primes):
    left = residues(matrix_of(tile.column("v"), width), primes)
    found = []
    for first, rows, labels, right in group.tiles():
        score = scores(left, right, primes)
        for number, row, column in find(tile, score, rows, labels, k):
            found.append((np.full(len(row), number), row, column + first, score[row, column]))
    number, row, column, score = (np.concatenate(x) for x in zip(*found, strict=True))
    kept = first_of_each(number * tile.num_rows + row, score, column, k)
    at = pa.array(column[kept])
    yield pa.RecordBatch.from_arrays(
        [tile.column("row").take(pa.array(row[kept])), pa.array(number[kept].astype(np.int32)),
         pa.array(score[kept]), group.ids.take(at), pa.array(group.rows[column[kept]])], names=names)


def _same_label(tile, score, rows, labels, k):
    own = tile.column("row").to_numpy()[:, None] != rows[None, :]
    yield 0, *best(score, own & (tile.column("label").to_numpy()[:, None] == labels[None, :]), k)


def _in_windows(low: int, high: int):
    def find(tile, score, rows, labels, k):
        other = tile.column("label").to_numpy()[:, None] != labels[None, :]
        present = np.array([len(s) for s in tile.column("scores").to_pylist()])
        wanted = matrix_of(tile.column("scores"), int(present.max()))
        for j in range(wanted.shape[1]):
            positive = wanted[:, j, None]
            inside = (low * positive <= 100 * score) & (100 * score <= high * positive)
            yield j, *best(score, other & inside & (present > j)[:, None], k)
    return find


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The rows of (vec_id, label, embedding) that take part: vec_id, label and
    ``v``, the components times ``scale`` rounded down."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & good).select(
        "vec_id", F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, group_cells: int = CELLS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; ``vectors`` has vec_id, label and ``v`` (whole numbers)."""
    spark = vectors.sparkSession
    rows = written(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"),
                                  "label", "v", F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("square")).first()
    n, width, bound = size["n"], max(size["width"] or 0, 1), int((size["square"] or 0) * (1 + 1e-9)) + 1
    if bound * 100 >= 1 << 63:
        raise ValueError(f"scores of up to {bound} do not fit the windows' 64 bits")
    primes = moduli(bound)
    most = max(1, group_cells // width)
    groups = max(1, math.ceil(n / most), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / LEAST_GROUP)))
    # the row's number is a key of its own, so copies of a row spread as well
    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("turn"),
                        "row", "id", "label", "v")
    anchors = rows.where("anchor").select("row", "id", "label", "v")

    def against_all(queries: DataFrame, find, k: int) -> DataFrame:
        extra = queries.columns[4:]
        sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("turn"),
                              *queries.columns)
        both = dealt.select("*", *[F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in extra]).unionByName(sent)
        both = both.repartition(groups, "group").sortWithinPartitions("group", "turn")
        names = ["anchor", "at", "score", "found_id", "found"]
        partial = map_batches(both, _against_all(find, names, k, width, primes),
                              "anchor long, at int, score long, found_id long, found long")
        order = Window.partitionBy("anchor", "at").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found")
        return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best_same = written(against_all(anchors, _same_label, positives).select(
        "anchor", (F.col("rank") - 1).alias("at"), F.col("found_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # at most ``positives`` scores an anchor
    wanted = best_same.groupBy("anchor").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "positive_score"))), lambda s: s["positive_score"]).alias("scores"))
    queries = anchors.join(wanted, F.col("row") == F.col("anchor")).select("row", "id", "label", "v", "scores")
    found = against_all(queries, _in_windows(*window), negatives)
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(best_same, ["anchor", "at"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def oracle(every: int, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW) -> str:
    """DuckDB SQL for the query, whose anchors are every ``every``-th id."""
    return f"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % {every} = 0),
p AS (SELECT a, anchor_id, other AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY a ORDER BY score DESC, other NULLS LAST, b) AS j
      FROM s WHERE same QUALIFY j <= {positives}),
n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.a, p.j ORDER BY s.score DESC, s.other NULLS LAST, s.b) AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same
      WHERE {window[0]} * positive_score <= 100 * score AND 100 * score <= {window[1]} * positive_score
      QUALIFY rank <= {negatives})
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
