"""Vector expressions on ``ARRAY<DOUBLE>`` columns.

Two spellings are offered for every operation:

* *unrolled*: when the dimension ``d`` is known, the expression is written out
  element by element (``v[0]``, ``v[1]``, ...).  Element access and arithmetic
  are whole-stage-codegen expressions, so the hot loop stays in generated JVM
  code.  Sums are built as balanced trees to keep the expression depth at
  ``log2(d)``.
* *higher-order*: ``zip_with`` + ``aggregate`` for an unknown or very large
  ``d``.  Still JVM-side, but interpreted.

Nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many terms an unrolled expression becomes a very large generated
# method; fall back to the higher-order form.  Both give the same value on
# vectors that ``check_vectors`` has passed.
UNROLL_LIMIT = 256


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tree_sum(terms: Sequence[Column]) -> Column:
    """Sum a list of columns as a balanced tree (depth log2(n))."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        nxt = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def vector_dim(df: DataFrame, col: str) -> int:
    """Dimension of a vector column, read from one row (a limit-1 scan)."""
    row = df.select(F.size(col).alias("d")).where(F.col(col).isNotNull()).limit(1).collect()
    if not row:
        raise ValueError(f"column {col!r} holds no vector")
    return int(row[0]["d"])


def check_vectors(df: DataFrame, col: str, d: int | None = None, na: str = "error") -> tuple[DataFrame, int]:
    """``df`` with every vector of ``col`` checked inside the scan that reads
    it, and the common dimension (that of one row unless given).  A vector
    that is null, has another dimension, or holds a null or NaN fails the job
    (``na="error"``) or its row is left out (``"drop"``)."""
    d = d or vector_dim(df, col)
    v = F.col(col)
    bad = F.coalesce(v.isNull() | (F.size(v) != d) | F.exists(v, lambda x: x.isNull() | F.isnan(x)), F.lit(True))
    if na == "drop":
        return df.where(~bad), d
    if na != "error":
        raise ValueError("na must be 'error' or 'drop'")
    message = F.lit(f"column {col}: a vector is null, holds null or NaN, or has not {d} coordinates")
    return df.where(F.when(bad, F.raise_error(message)).otherwise(F.lit(True))), d


def as_double_array(col) -> Column:
    return _col(col).cast("array<double>")


def _elem(v, i: int):
    if isinstance(v, (list, tuple)):
        return F.lit(float(v[i]))
    return _col(v)[i]


def squared_distance(a, b, d: int | None = None) -> Column:
    """Squared Euclidean distance (F5).  ``a``/``b`` are columns, column names
    or Python sequences of numbers (a literal centre)."""
    if d is not None and d <= UNROLL_LIMIT:
        terms = []
        for i in range(d):
            diff = _elem(a, i) - _elem(b, i)
            terms.append(diff * diff)
        return tree_sum(terms)
    a_c = F.array(*[F.lit(float(x)) for x in a]) if isinstance(a, (list, tuple)) else _col(a)
    b_c = F.array(*[F.lit(float(x)) for x in b]) if isinstance(b, (list, tuple)) else _col(b)
    return F.aggregate(F.zip_with(a_c, b_c, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


def euclidean_distance(a, b, d: int | None = None) -> Column:
    """Euclidean distance."""
    return F.sqrt(squared_distance(a, b, d))


def dot(a, b, d: int | None = None) -> Column:
    """Inner product."""
    if d is not None and d <= UNROLL_LIMIT:
        return tree_sum([_elem(a, i) * _elem(b, i) for i in range(d)])
    a_c = F.array(*[F.lit(float(x)) for x in a]) if isinstance(a, (list, tuple)) else _col(a)
    b_c = F.array(*[F.lit(float(x)) for x in b]) if isinstance(b, (list, tuple)) else _col(b)
    return F.aggregate(F.zip_with(a_c, b_c, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def distance_array(vec, centres: Sequence[Sequence[float]], d: int) -> Column:
    """``array(|v-c_0|^2, ..., |v-c_{K-1}|^2)`` for K literal centres.

    The centres are K x d numbers held by the driver (bounded by K and d, never
    by the row count); each distance is an unrolled codegen expression.
    """
    return F.array(*[squared_distance(vec, list(c), d) for c in centres])


def first_argmin(arr) -> Column:
    """0-based index of the first minimum of an array column.

    ``array_position`` returns the first match, so ties go to the lowest index,
    the same as a strict ``<`` scan.
    """
    a = _col(arr)
    return (F.array_position(a, F.array_min(a)) - 1).cast("int")
