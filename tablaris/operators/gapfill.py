"""Make an integer or date key dense by inserting the missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Longest array a single row may hold while a per-entity range is unfolded.
CHUNK = 4096


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key; NULLs on an empty table."""
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def _is_date(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.DateType)


def _number(df: DataFrame, key: str) -> Column:
    return F.unix_date(key) if _is_date(df, key) else F.col(key)


def _value(df: DataFrame, key: str, number: Column) -> Column:
    if _is_date(df, key):
        number = F.date_from_unix_date(number.cast("int"))
    return number.cast(df.schema[key].dataType).alias(key)


def _left_fill(
    spine: DataFrame, df: DataFrame, key: str, flag: str, entity: Sequence[str] = ()
) -> DataFrame:
    """Spine rows with their data; rows the data lacks are flagged 1."""
    keys = [*entity, key]
    data = df.select(
        *[F.col(c).alias(f"_k_{c}" if c in keys else c) for c in df.columns],
        F.lit(1).alias("_present"),
    )
    on = F.col(key) == F.col(f"_k_{key}")
    for c in entity:
        on &= F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    filled = spine.join(data, on, "left")
    filled = filled.select(*df.columns, F.col("_present").isNull().cast("int").alias(flag))
    # Rows without a key have no place in the series and stay as they are.
    return filled.union(df.where(F.col(key).isNull()).withColumn(flag, F.lit(0)))


def fill_gaps(
    df: DataFrame,
    key: str,
    flag: str = "inserted",
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """One row for every key from the smallest to the largest.

    ``df`` holds each key once; rows whose key is NULL stay, unflagged, and a key
    held several times stays as often. The spine is generated in parallel; only the
    two bounds are fetched, unless the caller already knows them.
    """
    if bounds is None:
        number = _number(df, key)
        bounds = df.agg(F.min(number), F.max(number)).first()
    low, high = bounds
    if low is None:
        return df.withColumn(flag, F.lit(0))
    spine = df.sparkSession.range(int(low), int(high) + 1)
    return _left_fill(spine.select(_value(df, key, F.col("id"))), df, key, flag)


def fill_gaps_per_entity(
    df: DataFrame, entity: Sequence[str], key: str, flag: str = "inserted"
) -> DataFrame:
    """As :func:`fill_gaps`, from each entity's own first to its own last key.

    An entity's range is unfolded in two steps so that no row carries a long
    array, and spread over tasks in between; the join is on entity and key, so
    one long-lived entity does not end up in one task.
    """
    number = _number(df, key).cast("long")
    ranges = df.groupBy(*entity).agg(F.min(number).alias("_low"), F.max(number).alias("_high"))
    starts = ranges.select(
        *entity,
        "_high",
        F.explode(F.sequence("_low", "_high", F.lit(CHUNK).cast("long"))).alias("_from"),
    )
    # A stated number of partitions is not merged at run time: these rows are
    # few and small, but each unfolds to CHUNK more.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = starts.repartition(tasks, *entity, "_from")
    stop = F.least(F.col("_high"), F.col("_from") + (CHUNK - 1))
    spine = spread.select(*entity, F.explode(F.sequence("_from", stop)).alias("_number"))
    spine = spine.select(*entity, _value(df, key, F.col("_number")))
    return _left_fill(spine, df, key, flag, entity)
