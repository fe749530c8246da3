"""Interquartile fences: find them once, then flag and cap with plain literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.operators.quantiles import quantiles


@dataclass(frozen=True)
class Fence:
    """Quartiles of a column and the limits derived from them."""

    q1: float
    q3: float
    low: float
    high: float

    @staticmethod
    def around(q1: float, q3: float, reach: float) -> Fence:
        spread = q3 - q1
        return Fence(q1, q3, q1 - reach * spread, q3 + reach * spread)


def iqr_fences(
    df: DataFrame, columns: Sequence[str], mode: str = "exact", reach: float = 1.5
) -> dict[str, Fence | None]:
    """Fences of all columns from shared passes; None for a column without values."""
    found = quantiles(df, columns, [0.25, 0.75], mode)
    return {
        c: None if q1 is None else Fence.around(float(q1), float(q3), reach)
        for c, (q1, q3) in found.items()
    }


def fence_table(df: DataFrame, columns: Sequence[str], mode: str = "exact") -> DataFrame:
    """One row of quartiles and limits per column."""
    rows = [
        (c, f.q1, f.q3, f.low, f.high) if f else (c, None, None, None, None)
        for c, f in iqr_fences(df, columns, mode).items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, q3 double, low double, high double"
    )


def is_outlier(column: str, fence: Fence | None) -> Column:
    """Strictly outside the limits; NULL and unfenced values are not outliers."""
    if fence is None:
        return F.lit(False)
    col = F.col(column)
    return F.coalesce((col < fence.low) | (col > fence.high), F.lit(False))


def capped(column: str, fence: Fence | None) -> Column:
    col = F.col(column)
    if fence is None:
        return col
    low, high = F.lit(fence.low), F.lit(fence.high)
    return F.when(col < low, low).when(col > high, high).otherwise(col)


def flag_outliers(
    df: DataFrame, fences: Mapping[str, Fence | None], prefix: str = "outlier_"
) -> DataFrame:
    """Add a 0/1 flag per fenced column."""
    return df.select(
        "*", *[is_outlier(c, f).cast("int").alias(f"{prefix}{c}") for c, f in fences.items()]
    )


def winsorize(
    df: DataFrame, fences: Mapping[str, Fence | None], prefix: str = "outlier_"
) -> DataFrame:
    """Flag outliers and pull them onto the nearest limit, in one projection."""
    return df.select(
        *[capped(c, fences[c]).alias(c) if c in fences else F.col(c) for c in df.columns],
        *[is_outlier(c, f).cast("int").alias(f"{prefix}{c}") for c, f in fences.items()],
    )
