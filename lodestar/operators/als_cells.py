"""ALS half-steps whose memory follows a chunk of ratings.

Spark's block ALS keeps a block's ratings and the vectors they need in a task's
heap.  Here the ratings are written once by user and once by item, packed a row
per id.  In a half-step a task reads the other side's vectors into a file of its
own without a name, maps it, and solves the ids of its cell chunk by chunk, so
it holds 8 bytes per fixed id and one chunk.  Nothing is shuffled between
half-steps; of each side only the last vectors are kept.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import remove_folder, scratch_path, ship_package

#: ratings sorted in one task, of one packed row, and solved at once (fewer if
#: their vectors have more numbers than that)
RATINGS_PER_PART = 2_000_000
RATINGS_PER_ROW = 256
RATINGS_PER_CHUNK = 200_000
NUMBERS_PER_CHUNK = 4_000_000
#: bytes of the vectors in a row
VECTOR_BYTES = 1024
#: numbers in the padded vectors of one product, and in its results
PADDED = 1 << 20

PACKED = "id int, pieces int, others binary, ratings binary"
VECTORS = "ids binary, vectors binary"


def fit_in_cells(data: DataFrame, n: int, rank: int, max_iter: int, reg: float, seed: int, cells: int) -> tuple[DataFrame, DataFrame]:
    """``(user factors, item factors)``, ``(id, features)`` each, of ``n``
    ratings (``user``, ``item``, ``rating``) after ``max_iter`` times solving
    the items, then the users.  A half-step has ``cells`` tasks, each of which
    reads all vectors of the other side.  The start vectors follow from seed
    and id alone."""
    spark = data.sparkSession
    ship_package(spark)
    rating = F.col("rating")
    bad = F.col("user").isNull() | F.col("item").isNull() | rating.isNull() | F.isnan(rating) | (F.abs(rating) == float("inf"))
    data = data.withColumn("rating", F.when(bad, F.raise_error(F.lit("ids must not be null, ratings must be finite"))).otherwise(rating))
    cells = max(cells, min(-(-n // RATINGS_PER_PART), spark.sparkContext.defaultParallelism))
    ratings = {side: _dealt(data, side, other, -(-n // (cells * RATINGS_PER_PART)) * cells, cells)
               for side, other in (("user", "item"), ("item", "user"))}
    now = {"user": _kept(_read(spark, ratings["user"], "cell int, " + PACKED).where("pieces > 0").select("id").mapInArrow(
        lambda batches: (_vectors(b.column("id").to_numpy(), _start(b.column("id").to_numpy(), rank, seed)) for b in batches), VECTORS))}
    for _ in range(max_iter):
        for side, other in (("item", "user"), ("user", "item")):
            solved = _solved(_read(spark, ratings[side], "cell int, " + PACKED), _read(spark, now[other], VECTORS), rank, reg, cells)
            if side in now:
                remove_folder(spark, now[side])
            now[side] = solved
    factors = tuple(_features(_read(spark, now[side], VECTORS), rank) for side in ("user", "item"))
    for path in (*ratings.values(), *now.values()):
        remove_folder(spark, path)
    return factors


def _read(spark, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _kept(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "als")
    df.write.parquet(path)
    return path


# ------------------------------------------------------------------ ratings by id


def _dealt(data: DataFrame, side: str, other: str, parts: int, cells: int) -> str:
    """Folder with the ratings packed by the ids of ``side``, by cell."""
    path = scratch_path(data.sparkSession, f"als-by-{side}")
    part = F.pmod(F.xxhash64(side), F.lit(parts)).cast("int")
    key = F.shiftleft(F.col(side).cast("long"), 32) + F.col(other) + 2**31  # both ids in one number, sorted without comparing rows
    rows = data.select(part.alias("part"), key.alias("key"), "rating")
    per_row = RATINGS_PER_ROW
    dealt = rows.repartitionById(parts, "part").sortWithinPartitions("key")
    dealt.mapInArrow(lambda batches: _packed(batches, cells, per_row), "cell int, " + PACKED).write.partitionBy("cell").parquet(path)
    return path


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of consecutive rows of ``values`` that end at ``ends``."""
    width = values.itemsize * int(np.prod(values.shape[1:]))
    offsets = np.concatenate([[0], ends]).astype(np.int64) * width
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(batches: Iterator[pa.RecordBatch], cells: int, per_row: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their ids as a row per id: its others and ratings.  An
    id of many ratings has several rows, of which the last has their number in
    ``pieces``, the others 0."""
    held, sent = None, 0  # the last id's ratings so far, and its rows that have left
    names = ("part", "id", "other", "rating")
    for batch in chain(batches, [None]):
        if batch is not None and not batch.num_rows:
            continue
        columns = None
        if batch is not None:
            part, key, rating = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "key", "rating"))
            columns = dict(zip(names, (part, (key >> 32).astype(np.int32), ((key & 0xFFFFFFFF) - 2**31).astype(np.int32), rating), strict=True))
        if held is not None:
            columns = {c: np.concatenate([held[c], columns[c]]) for c in names} if columns else held
        if columns is None:
            return
        ids = columns["id"]
        begin = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        whole = len(ids) if batch is None else int(begin[-1])  # rows of ids that are complete
        count = np.diff(np.append(begin, len(ids)))
        rows = -(-count // per_row)
        if batch is not None:  # of the last id, full rows with something behind them
            rows[-1] -= 1
        of = np.repeat(np.arange(len(begin)), rows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
        end = np.minimum(begin[of] + (nth + 1) * per_row, begin[of] + count[of])
        left = rows + np.where(np.arange(len(begin)) == 0, sent, 0)
        pieces = np.where((nth == rows[of] - 1) & (begin[of] < whole), left[of], 0)
        gone = int(end[-1]) if len(end) else 0
        if gone:
            yield pa.RecordBatch.from_arrays(
                [pa.array((columns["part"][begin[of]] % cells).astype(np.int32)), pa.array(ids[begin[of]]), pa.array(pieces.astype(np.int32)),
                 _binary(columns["other"][:gone], end), _binary(columns["rating"][:gone], end)], names=["cell", "id", "pieces", "others", "ratings"])
        sent = int(left[-1])
        held = {c: v[gone:] for c, v in columns.items()}


# ------------------------------------------------------------------ vectors


def _vectors(ids: np.ndarray, vectors: np.ndarray, kind=np.float32) -> pa.RecordBatch:
    """Rows of as many vectors as ``VECTOR_BYTES`` hold, and their ids."""
    some = max(1, VECTOR_BYTES // (4 * vectors.shape[1]))
    ends = np.append(np.arange(some, len(ids), some), len(ids)) if len(ids) else np.empty(0, int)
    return pa.RecordBatch.from_arrays([_binary(ids.astype(np.int32), ends), _binary(vectors.astype(kind), ends)], names=["ids", "vectors"])


def _start(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Unit vectors in the first quadrant, normal numbers made of (seed, id)."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64)[:, None] * np.uint64(2 * rank) + np.arange(2 * rank, dtype=np.uint64)
        z = z * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % 2**64) * np.uint64(0xD1342543DE82EF95)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
    g = np.abs(np.sqrt(-2 * np.log1p(-u[:, :rank])) * np.cos(2 * np.pi * u[:, rank:])) + 1e-12
    return g / np.linalg.norm(g, axis=1, keepdims=True)


def _features(vectors: DataFrame, rank: int) -> DataFrame:
    """``(id, features ARRAY<FLOAT>)`` as in Spark's model."""
    def run(batches):
        for b in batches:
            numbers = _numbers(b.column("vectors"), np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(_numbers(b.column("ids"), np.int32)), pa.ListArray.from_arrays(
                np.arange(0, len(numbers) + 1, rank, dtype=np.int32), numbers)], names=["id", "features"])
    schema = "id int, features array<float>"
    spark = vectors.sparkSession
    return _read(spark, _kept(vectors.mapInArrow(run, schema)), schema)


def _numbers(column: pa.Array, kind) -> np.ndarray:
    """All numbers in the rows of a binary column without nulls."""
    if not len(column):
        return np.empty(0, kind)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind)


class _Fixed:
    """The other side's vectors in a file without a name, found by id."""

    def __init__(self, n: int, rank: int, kind=np.float32):
        self.n, self.rank, self.kind, self.file, self.seen, self.ids = n, rank, kind, tempfile.TemporaryFile(), 0, np.empty(n, np.int32)

    @property
    def complete(self) -> bool:
        return self.seen == self.n

    def add(self, rows: pa.RecordBatch) -> None:
        ids, numbers = _numbers(rows.column("others"), np.int32), _numbers(rows.column("ratings"), self.kind)
        self.ids[self.seen:self.seen + len(ids)] = ids
        self.file.write(numbers.tobytes())
        self.seen += len(ids)
        if self.complete and self.n:
            self.file.flush()
            self.at = np.argsort(self.ids).astype(np.int32)
            self.ids = self.ids[self.at]
            self.vectors = np.memmap(self.file, self.kind, "r", shape=(self.n, self.rank))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Their vectors, of unknown ids any, and one of zeros; and which are known."""
        place = np.minimum(np.searchsorted(self.ids, ids), self.n - 1)
        vectors = np.zeros((len(ids) + 1, self.rank))
        vectors[:-1] = self.vectors[self.at[place]]
        return vectors, self.ids[place] == ids


# ------------------------------------------------------------------ half-steps


def _solved(ratings: DataFrame, fixed: DataFrame, rank: int, reg: float, cells: int) -> str:
    """Folder with the solved vectors of all ids in ``ratings``."""
    n = fixed.agg(F.sum(F.length("ids"))).first()[0] // 4
    per_chunk, sums, answer = _per_chunk(rank), _normal_equations, _solutions(reg)
    return _in_cells(ratings, [_as_table(fixed, -1)] * cells,
                     lambda c: lambda batches: _half_step(batches, {-1: _Fixed(n, rank)}, sums, answer, per_chunk), VECTORS)


def residuals_in_cells(solved: DataFrame, fixed: DataFrame, pairs: DataFrame, n: int, rank: int, reg: float, cells: int) -> DataFrame:
    """``(id, gg, bb)`` of :func:`lodestar.operators.recommend.normal_equation_residuals`:
    the squared norms of both sums of each solved id with ratings.  The ids of
    both tables (INT, without null) come once.  ``pairs`` are ``n`` rows ``(user, item, rating)``."""
    ship_package(pairs.sparkSession)
    spark = pairs.sparkSession
    cells = max(cells, min(-(-n // RATINGS_PER_PART), spark.sparkContext.defaultParallelism))
    parts = -(-n // (cells * RATINGS_PER_PART)) * cells
    ratings = _dealt(pairs, "user", "item", parts, cells)
    cell = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int") % cells
    counts = {r["cell"]: r["count"] for r in solved.groupBy(cell.alias("cell")).count().collect()}  # a row per cell
    n_fixed = fixed.count()
    kind = {c: np.float32 if t.schema["features"].dataType.elementType == T.FloatType() else np.float64 for c, t in ((-1, fixed), (-2, solved))}
    table = _as_table(_read(spark, _kept(_binary_vectors(fixed, kind[-1])), VECTORS), -1)
    per_chunk, sums = _per_chunk(rank), _equation_sums(reg)
    own = [_as_table(_binary_vectors(solved.where(cell == c), kind[-2]), -2).coalesce(1) for c in range(cells)]

    def run(c):
        n_own = counts.get(c, 0)
        return lambda batches: _half_step(batches, {-1: _Fixed(n_fixed, rank, kind[-1]), -2: _Fixed(n_own, rank, kind[-2])},
                                          sums, _norms, per_chunk, np.float64)
    schema = "id long, gg double, bb double"
    norms = _in_cells(_read(spark, ratings, "cell int, " + PACKED), [table.coalesce(1).union(o) for o in own], run, schema)
    remove_folder(spark, ratings)
    return _read(spark, norms, schema)


def _per_chunk(rank: int) -> int:
    return max(1, min(RATINGS_PER_CHUNK, NUMBERS_PER_CHUNK // rank))


def _as_table(vectors: DataFrame, mark: int) -> DataFrame:
    return vectors.select(F.lit(0).alias("id"), F.lit(mark).alias("pieces"), F.col("ids").alias("others"), F.col("vectors").alias("ratings"))


def _binary_vectors(factors: DataFrame, kind) -> DataFrame:
    """``(id, features)`` as rows of ``VECTORS``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                ids, numbers = b.column("id").to_numpy(), b.column("features").flatten().to_numpy(zero_copy_only=False)
                yield _vectors(ids, numbers.reshape(len(ids), -1), kind)
    return factors.select("id", "features").mapInArrow(run, VECTORS)


def _in_cells(ratings: DataFrame, tables: list[DataFrame], run, schema: str) -> str:
    """Folder with what ``run(c)`` makes of the rows of ``tables[c]`` and then
    the ratings of cell ``c``, which come to one task."""
    each = [table.coalesce(1).union(ratings.where(F.col("cell") == c).select("id", "pieces", "others", "ratings").coalesce(1))
            .coalesce(1).mapInArrow(run(c), schema) for c, table in enumerate(tables)]
    spark = ratings.sparkSession
    before = spark.conf.get(_UNION, None)
    spark.conf.set(_UNION, "false")  # else a union of single partitions is a single partition
    try:
        return _kept(reduce(DataFrame.union, each))
    finally:
        spark.conf.unset(_UNION) if before is None else spark.conf.set(_UNION, before)


_UNION = "spark.sql.unionOutputPartitioning"


def _half_step(batches: Iterator[pa.RecordBatch], tables: dict[int, _Fixed], sums, answer, per_chunk: int,
               kind=np.float32) -> Iterator[pa.RecordBatch]:
    """``answer`` to the ``sums`` over each id's ratings (numbers of ``kind``).
    Rows with a negative ``pieces`` are vectors of that one of ``tables``."""
    parts: dict = {}  # sums of ids of which rows are still to come

    def answers(some):
        return _answers(tables, some, sums, answer, parts, per_chunk, kind)

    chunk, size = [], 0
    early = None  # ratings that come before the tables' end wait in a file
    for batch in batches:
        pieces = batch.column("pieces").to_numpy()
        for mark, table in tables.items():
            if (pieces == mark).any():
                table.add(batch.filter(pa.array(pieces == mark)))
        if len(pieces) and pieces.min() < 0:
            batch = batch.filter(pa.array(pieces >= 0))
        if not batch.num_rows:
            continue
        if not all(t.complete for t in tables.values()):
            early = early or _Spool(batch.schema)
            early.add(batch)
            continue
        chunk.append(batch)
        size += len(_numbers(batch.column("others"), np.int32))
        if size >= per_chunk:
            yield from answers(chunk)
            chunk, size = [], 0
    for batch in early.batches() if early else ():
        yield from answers([batch])
    if chunk:
        yield from answers(chunk)
    if parts:
        raise RuntimeError(f"ratings are missing of ids {sorted(parts)[:5]}")


class _Spool:
    def __init__(self, schema: pa.Schema):
        self.file = tempfile.TemporaryFile()
        self.writer = pa.ipc.new_stream(self.file, schema)

    def add(self, batch: pa.RecordBatch) -> None:
        self.writer.write_batch(batch)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.writer.close()
        self.file.seek(0)
        return iter(pa.ipc.open_stream(self.file))


def _answers(tables, batches: list[pa.RecordBatch], sums, answer, parts: dict, per_chunk: int, kind) -> Iterator[pa.RecordBatch]:
    if not all(t.n for t in tables.values()):
        return
    rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    ids, pieces = rows.column("id").to_numpy(), rows.column("pieces").to_numpy()
    ends = np.cumsum(pc.binary_length(rows.column("others")).to_numpy().astype(np.int64)) // 4
    others, ratings = _numbers(rows.column("others"), np.int32), _numbers(rows.column("ratings"), kind)
    first = 0
    while first < len(ends):  # a batch may be larger than a chunk
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + per_chunk, "right")))
        upto = int(ends[last - 1])
        found = []
        for group, y, r, n in _groups(tables[-1], others[done:upto], ratings[done:upto], ends[first:last] - done):
            group = group + first
            ready = ids[group], *sums(tables, ids[group], y, r, n)
            if (pieces[group] != 1).any():
                ready = _together(*ready, pieces[group], parts)
            if len(ready[0]):
                found.append(answer(*ready))
        if found:
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            yield _vectors(*columns) if len(columns) == 2 else pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["id", "gg", "bb"])
        first = last


def _groups(fixed: _Fixed, others, ratings, ends):
    """``(rows, their vectors, their ratings, their number)`` of rows of about
    as many ratings, filled up with zeros; ratings of unknown others left out."""
    rank = fixed.rank
    need, at = np.unique(others, return_inverse=True)
    vectors, known = fixed.of(need)
    at[~known[at]] = len(need)
    begin = np.concatenate([[0], ends[:-1]])
    count = ends - begin
    by = np.argsort(count, kind="stable")
    ordered, a = count[by], 0
    while a < len(by):
        most = int(ordered[a]) * 9 // 8
        b = min(int(np.searchsorted(ordered, most, "right")), a + max(1, PADDED // (rank * max(rank, most))))
        group, width, a = by[a:b], int(ordered[b - 1]), b
        inside = np.arange(width) < count[group][:, None]
        where = np.where(inside, begin[group][:, None] + np.arange(width), 0)
        place = np.where(inside, at[where], len(need))
        rated = place < len(need)
        yield group, vectors[place], np.where(rated, ratings[where], 0.0), rated.sum(axis=1).astype(np.float64)


def _normal_equations(tables, ids, y, r, n):
    turned = y.transpose(0, 2, 1)
    return turned @ y, (turned @ r[:, :, None])[:, :, 0], n


def _solutions(reg: float):
    def answer(ids, left, right, n):
        diagonal = np.arange(right.shape[1])
        left[:, diagonal, diagonal] += (reg * n)[:, None]
        return ids, np.linalg.solve(left, right[:, :, None])[:, :, 0].astype(np.float32)
    return answer


def _equation_sums(reg: float):
    """``sum (y.x - r) y + reg x`` and ``sum r y``; an id without a vector x
    counts no ratings."""
    def sums(tables, ids, y, r, n):
        x, known = tables[-2].of(ids)
        x = x[:-1]
        error = (y @ x[:, :, None])[:, :, 0] - r
        turned = y.transpose(0, 2, 1)
        return (turned @ error[:, :, None])[:, :, 0] + (reg * n)[:, None] * x, (turned @ r[:, :, None])[:, :, 0], np.where(known, n, 0)
    return sums


def _norms(ids, left, right, n):
    rated = n > 0
    return ids[rated].astype(np.int64), (left[rated] ** 2).sum(axis=1), (right[rated] ** 2).sum(axis=1)


def _together(ids, left, right, n, pieces, parts):
    """Sums of complete ids, those of several rows added up."""
    out, found = [], {}
    for k, whole in enumerate(pieces == 1):
        if whole:
            out.append(k)
            continue
        sums = parts.setdefault(int(ids[k]), [0, 0, 0.0, 0.0, 0.0])
        for i, x in enumerate((1, int(pieces[k]), left[k], right[k], n[k])):
            sums[i] = sums[i] + x
        if sums[0] == sums[1]:
            found[k] = parts.pop(int(ids[k]))[2:]
            out.append(k)
    for k, sums in found.items():
        left[k], right[k], n[k] = sums
    return ids[out], left[out], right[out], n[out]
