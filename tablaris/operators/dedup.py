"""Duplicate removal.

Both operators shrink each key to one row inside the map task before the
shuffle, so a key holding a large share of the table sends one row per task:
``row_number() = 1`` is planned as a group limit on both sides of the exchange
and ``dropDuplicates`` as a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ingest_order() -> Column:
    """Fallback row order: file, position of the split in the file, row in the split.

    Unlike a bare increasing id it does not change when splits are packed into
    tasks differently. Only for frames read straight from files.
    """
    meta = F.col("_metadata")
    return F.struct(
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """First row of each key in ``order_by`` order."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def drop_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
