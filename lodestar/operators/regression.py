"""Least squares by the normal equations.

``w = (XᵀX)⁻¹ Xᵀy`` with the moments from one aggregate pass and a d x d
``numpy.linalg.solve`` on the driver (centred form when an intercept column is
present).  Scoring is a linear column expression, so it stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.stats import UNROLLED_GRAM_MAX_COLS, complete_rows, covariance_matrix, gram, vector_mean


class CollinearError(ValueError):
    pass


def _covariance_moments(df: DataFrame, xs: Sequence[str], target: str):
    """Sample covariances among the features and with the target, and the
    means: one aggregate up to ``UNROLLED_GRAM_MAX_COLS`` columns; beyond, one
    pass for the means and one of blocked partial sums around them
    (``stats.covariance_long``), so wide inputs stay d^2 numbers."""
    columns = [*xs, target]
    if len(columns) <= UNROLLED_GRAM_MAX_COLS:
        pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.covar_samp(columns[i], columns[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
        means = {c: row[f"m{i}"] for i, c in enumerate(columns)}
        cov = np.empty((len(columns), len(columns)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = np.nan if row[f"s{i}_{j}"] is None else row[f"s{i}_{j}"]
        return cov[:-1, :-1], cov[:-1, -1], means
    row = df.select(F.array(*columns).alias("v"))
    mean, _ = vector_mean(row, "v")
    cov = covariance_matrix(row, "v")
    means = dict(zip(columns, mean.tolist(), strict=True))
    return cov[:-1, :-1], cov[:-1, -1], means


def _dependent_columns(m: np.ndarray, names: Sequence[str]) -> list[str]:
    dep, basis = [], []
    for i, c in enumerate(names):
        if np.linalg.matrix_rank(m[np.ix_(basis + [i], basis + [i])]) == len(basis) + 1:
            basis.append(i)
        else:
            dep.append(c)
    return dep


def ols_fit(df: DataFrame, features: Sequence[str], target: str, na: str = "error",
            use_pinv: bool = False, intercept_col: str | None = "intercept") -> dict[str, float]:
    """Coefficients by name, in ``features`` order (put ``intercept`` last for
    the reference's layout, 7.4#13).

    When ``intercept_col`` (a constant-1 column) is among the features, the
    same normal equations are solved in centred form: slopes from the feature
    covariance matrix and the feature/target covariances, intercept from the
    means.  This is algebraically ``(XᵀX)⁻¹Xᵀy`` but does not lose digits when
    features have very different scales.  Without an intercept the raw moments
    ``XᵀX``, ``Xᵀy`` are used.  Up to 24 columns this is one aggregate; the
    driver gets d x d numbers.

    ``na="error"`` fails on a null in any used column (a null would otherwise
    turn every coefficient into NaN); ``"drop"`` removes such rows.  A singular
    system raises :class:`CollinearError` naming the dependent columns unless
    ``use_pinv`` (7.4#14).
    """
    data = complete_rows(df, [*features, target], na)
    solve = (lambda a, b: np.linalg.pinv(a) @ b) if use_pinv else np.linalg.solve

    if intercept_col and intercept_col in features:
        xs = [c for c in features if c != intercept_col]
        cov, cxy, means = _covariance_moments(data, xs, target)
        if not xs:                      # intercept only: the mean of the target
            return {intercept_col: float(means[target])}
        if np.linalg.matrix_rank(cov) < len(xs) and not use_pinv:
            raise CollinearError(f"XᵀX is singular; dependent columns: {_dependent_columns(cov, xs)}")
        slopes = solve(cov, cxy)
        w = dict(zip(xs, map(float, slopes)))
        w[intercept_col] = float(means[target] - sum(w[c] * means[c] for c in xs))
        return {c: w[c] for c in features}

    xtx, xty, _ = gram(data, list(features), target)
    if np.linalg.matrix_rank(xtx) < len(features) and not use_pinv:
        raise CollinearError(f"XᵀX is singular; dependent columns: {_dependent_columns(xtx, features)}")
    w = solve(xtx, xty)
    return {c: float(v) for c, v in zip(features, w)}


def ols_predict(df: DataFrame, coefficients: dict[str, float], out: str = "prediction"):
    """``ŷ = Σ w_i x_i`` as one column expression (M22), by column name."""
    expr = None
    for c, w in coefficients.items():
        term = F.col(c).cast("double") * F.lit(float(w))
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr)


def coefficients_frame(spark, coefficients: dict[str, float]) -> DataFrame:
    """Coefficients as ``(feature, coefficient)`` rows (d rows)."""
    return spark.createDataFrame([(k, float(v)) for k, v in coefficients.items()],
                                 "feature string, coefficient double")
