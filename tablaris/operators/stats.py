"""Summaries of whole tables, each from as few aggregates as it allows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablaris.operators.moments import pair_moments
from tablaris.operators.quantiles import interpolated_quantiles
from tablaris.operators.tiles import correlation_table

# Columns up to which a correlation matrix is a single matrix.
WIDE = 512


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs (0 on an empty table)."""
    row = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
            for c in columns
        ]
    )
    return df.agg(row.alias("r")).select(F.inline("r"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and non-NULL count of every column."""
    row = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count(F.col(f.name)).alias("non_null"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(row.alias("r")).select(F.inline("r"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles per column."""
    quartiles = interpolated_quantiles(df, columns, [0.25, 0.5, 0.75])

    def summary(c: str):
        low, mid, high = (F.lit(v).cast("double") for v in quartiles[c])
        return F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            low.alias("q25"),
            mid.alias("q50"),
            high.alias("q75"),
            F.max(c).cast("double").alias("max"),
        )

    return df.agg(F.array(*[summary(c) for c in columns]).alias("r")).select(F.inline("r"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations, both triangles, one row per pair.

    One pass over the rows; each pair counts those where both are known. A pair
    without spread, or without rows, has NULL. Tables of more than WIDE columns are
    done in tiles, which never are in one place.
    """
    if len(columns) > WIDE:
        return correlation_table(df, columns)
    found = pair_moments(df, columns).get(None)
    r = np.full((len(columns),) * 2, np.nan) if found is None else found.correlations()
    rows = [
        (a, b, None if np.isnan(r[i, j]) else float(r[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "variable_a string, variable_b string, r double")


def trend_lines(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Straight line of the label on each single feature."""
    row = F.array(
        *[
            F.struct(
                F.lit(x).alias("feature"),
                F.regr_slope(F.col(label), F.col(x)).alias("slope"),
                F.regr_intercept(F.col(label), F.col(x)).alias("intercept"),
            )
            for x in features
        ]
    )
    return df.agg(row.alias("r")).select(F.inline("r"))


def fitted_trends(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Each row with the trend line's value per feature, as ``trend_<feature>``."""
    lines = {r["feature"]: r for r in trend_lines(df, features, label).collect()}
    return df.select(
        "*",
        *[
            (F.lit(lines[x]["intercept"]) + F.lit(lines[x]["slope"]) * F.col(x)).alias(
                f"trend_{x}"
            )
            for x in features
        ],
    )
