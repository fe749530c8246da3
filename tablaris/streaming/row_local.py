"""Run a row-local chain over a stream.

Conforming, typing, validating, predicting and answering requests look at one
row at a time, so the batch functions take a streaming DataFrame unchanged.
Nothing here keeps state; the sink's checkpoint makes restarts exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append ``transform(stream)`` to a Parquet table until the source is drained."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
