"""Parquet tables, JSON reports, stored models and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """One-row report as a JSON file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def head_rows(df: DataFrame, count: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First rows in a stated order; planned as a top-k, not as a full sort."""
    return df.orderBy(*order_by).limit(count)
