"""Rounding helpers used to publish doubles that two engines can compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sig_round(c, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits.

    Written with exact powers of ten only (multiply for small numbers, divide
    for large ones), so any IEEE engine computing the same steps gets the same
    bits.  ``0`` and nulls pass through."""
    x = F.col(c) if isinstance(c, str) else c
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    up = F.pow(F.lit(10.0), k)
    down = F.pow(F.lit(10.0), -k)
    rounded = F.when(k >= 0, F.round(x * up, 0) / up).otherwise(F.round(x / down, 0) * down)
    return F.when(x == 0, F.lit(0.0)).otherwise(rounded) + F.lit(0.0)


def sql_sig_round(expr: str, digits: int = 10) -> str:
    """The same rounding as :func:`sig_round`, as DuckDB SQL text."""
    k = f"({digits - 1} - floor(log10(abs({expr}))))"
    return (f"(CASE WHEN ({expr}) = 0 THEN 0.0 WHEN {k} >= 0 "
            f"THEN round(({expr}) * pow(10, {k}), 0) / pow(10, {k}) "
            f"ELSE round(({expr}) / pow(10, -{k}), 0) * pow(10, -{k}) END + 0.0)")
