"""Lineage cuts: intermediate tables in the shared checkpoint folder.

A staged table is plain Parquet, so a later pass reads only the columns it
needs and a lost executor costs no recomputation of what came before.
"""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_run: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


def staging_root(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{warehouse}/_staged"


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, also after a failure.

    Only tables of this run go, not those of others in the same process. Frames
    that read them cannot be used afterwards, so sinks belong inside. Outside any
    run the caller of a query owns its staged tables.
    """
    paths: list[str] = []
    token = _run.set(paths)
    try:
        yield
    finally:
        _run.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        for path in paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh folder, remembered by the run it is made in."""
    path = f"{staging_root(spark)}/tablaris/{label}-{uuid.uuid4().hex}"
    paths = _run.get()
    if paths is not None:
        paths.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
