"""Fill NULLs from the nearest known neighbours in row order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.operators.ordering import WINDOW_ROWS, GroupSizes, neighbours
from tablaris.operators.quantiles import quantiles


@dataclass(frozen=True)
class Survey:
    """Group sizes, columns with NULLs, columns with a group of nothing but NULLs."""

    sizes: GroupSizes
    holes: tuple[str, ...]
    barren: tuple[str, ...]


def filled_value(column: str, median: float | None) -> Column:
    """Own value, else the neighbours' mean, else the one neighbour, else the median."""
    before, after = F.col(f"_prev_{column}"), F.col(f"_next_{column}")
    return F.coalesce(column, (before + after) / 2.0, before, after, F.lit(median).cast("double"))


def impute(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    flag_prefix: str = "imputed_",
    window_rows: int = WINDOW_ROWS,
    survey: Survey | None = None,
) -> DataFrame:
    """Replace NULLs in ``columns`` and flag the replaced ones.

    One aggregate first learns what is needed at all, unless the caller knows:
    columns without NULLs cost nothing more, and the table-wide median, the
    last resort, is computed only where some whole group is empty. Rows tied in
    ``order_by`` are told apart by their other columns. A run of NULLs gets equal values, as
    both neighbours are original ones. ``df`` is read again by the result, so
    stage it first if it is costly.
    """
    found = survey or take_survey(df, columns, group_by)
    holes, barren = found.holes, found.barren
    medians = {c: m for c, (m,) in quantiles(df, barren, [0.5]).items()} if barren else {}
    flags = [F.col(c).isNull().cast("int").alias(f"{flag_prefix}{c}") for c in columns]
    flagged = df.select("*", *flags)
    if not holes:
        return flagged
    seen = neighbours(flagged, holes, order_by, group_by, found.sizes, window_rows)
    return seen.select(
        *[
            filled_value(c, medians.get(c)).alias(c) if c in holes else F.col(c)
            for c in flagged.columns
        ]
    )


def take_survey(df: DataFrame, columns: Sequence[str], group_by: Sequence[str]) -> Survey:
    row = (
        df.groupBy(*group_by)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_{c}") for c in columns])
        .agg(
            F.sum("_n").alias("rows"),
            F.max("_n").alias("largest"),
            *[F.max(F.col(f"_{c}") < F.col("_n")).alias(f"holes_{c}") for c in columns],
            *[
                F.max((F.col(f"_{c}") == 0) & (F.col("_n") > 0)).alias(f"barren_{c}")
                for c in columns
            ],
        )
        .first()
    )
    return Survey(
        GroupSizes(row["rows"] or 0, row["largest"] or 0),
        tuple(c for c in columns if row[f"holes_{c}"]),
        tuple(c for c in columns if row[f"barren_{c}"]),
    )
