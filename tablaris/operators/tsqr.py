"""Least squares by orthogonal triangles, for columns that nearly depend on each other.

Co-moments square the condition of the columns: two that differ by 1e-9 of their
size look equal there. Here every task reduces its rows to the triangular factor of
(1, features, label) by orthogonal transformations, factors are merged 32 at a time
in a tree of tasks, and the fit is solved on the last factor, where the rank shows.
Memory is the square of the number of columns, on tasks and driver alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablaris.sources.staging import stage

# Factors that one task merges.
FAN_IN = 32
# Singular values of columns of length one below which they count as dependent.
RANK_TOLERANCE = 1e-13


@dataclass(frozen=True)
class Triangle:
    """Row count and triangular factor of (1, features, label)."""

    n: int
    r: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Triangle:
        """Of rows of features and label."""
        return cls(len(rows), np.linalg.qr(np.column_stack([np.ones(len(rows)), rows]), mode="r"))

    def merge(self, other: Triangle) -> Triangle:
        return Triangle(self.n + other.n, np.linalg.qr(np.vstack([self.r, other.r]), mode="r"))

    def solve(self) -> tuple[float, np.ndarray, bool]:
        """Intercept, coefficients, and whether the features were dependent (then the shortest)."""
        if self.n == 0:
            raise ValueError("no complete rows to fit")
        r = np.vstack([self.r, np.zeros((max(0, self.r.shape[1] - len(self.r)), self.r.shape[1]))])
        x, y = r[1:-1, 1:-1], r[1:-1, -1]  # the first row holds the means, the last what is left over
        length = np.linalg.norm(x, axis=0)
        dependent = bool((length == 0).any())
        if not dependent:
            dependent = bool(np.linalg.svd(x / length, compute_uv=False)[-1] < RANK_TOLERANCE * len(length))
        if dependent:
            coefficients = np.linalg.pinv(x, rcond=RANK_TOLERANCE * len(length)) @ y
        else:
            coefficients = np.linalg.lstsq(x / length, y, rcond=None)[0] / length
        return float((r[0, -1] - r[0, 1:-1] @ coefficients) / r[0, 0]), coefficients, dependent

    def score(self, intercept: float, coefficients: np.ndarray) -> tuple[float, float]:
        """Mean squared error and R² of a fit on these rows."""
        left = self.r @ np.concatenate([[-intercept], -coefficients, [1.0]])
        mse, spread = float(left @ left) / self.n, float(self.r[1:, -1] @ self.r[1:, -1]) / self.n
        if spread == 0:
            return mse, 1.0 if mse == 0 else 0.0
        return mse, 1 - mse / spread


def triangles(df: DataFrame, columns: Sequence[str], by: str | None = None, center: Mapping[str, float] | None = None) -> dict[object, Triangle]:
    """Triangles of complete rows for each value of ``by``, a column of a stated few values.

    Columns are doubles without NULLs, the label last. What ``center`` says is
    taken from a column first, which keeps digits where its spread is small.
    """
    center = center or {}
    width = len(columns)
    source = df.select(
        (F.col(by).cast("string") if by else F.lit(None).cast("string")).alias("by"),
        F.array(*[F.col(c) - F.lit(float(center.get(c, 0.0))) for c in columns]).alias("x"),
    )
    schema = "by string, node int, n long, r binary"

    def rows_of(totals: dict[str | None, Triangle]) -> pa.RecordBatch:
        node = TaskContext.get().partitionId()
        rows = [{"by": k, "node": node, "n": t.n, "r": np.ascontiguousarray(t.r).tobytes()} for k, t in totals.items()]
        return pa.RecordBatch.from_pylist(rows, pa.schema([("by", pa.string()), ("node", pa.int32()), ("n", pa.int64()), ("r", pa.binary())]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, Triangle] = {}
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            kinds = batch.column("by").dictionary_encode()
            codes = kinds.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for code in np.unique(codes).tolist():
                key = None if code < 0 else kinds.dictionary[code].as_py()
                part = Triangle.of(values[codes == code])
                totals[key] = totals[key].merge(part) if key in totals else part
        yield rows_of(totals)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, Triangle] = {}
        for batch in batches:
            for row in batch.to_pylist():
                part = read(row["n"], row["r"])
                totals[row["by"]] = totals[row["by"]].merge(part) if row["by"] in totals else part
        yield rows_of(totals)

    def read(n: int, r: bytes) -> Triangle:
        return Triangle(n, np.frombuffer(r).reshape(-1, width + 1))

    parts = stage(source.mapInArrow(gather, schema), "triangles")
    nodes = parts.agg(F.count_distinct("node")).first()[0]
    while nodes > FAN_IN:
        nodes = math.ceil(nodes / FAN_IN)
        parts = stage(parts.repartition(nodes, "node").mapInArrow(merge, schema), "triangles")
    totals: dict[str | None, Triangle] = {}
    for row in parts.orderBy("by", "node").collect():  # at most FAN_IN for each value of ``by``
        part = read(row["n"], bytes(row["r"]))
        totals[row["by"]] = totals[row["by"]].merge(part) if row["by"] in totals else part
    whole = dict(df.dtypes).get(by, "") in ("int", "bigint") if by else False
    return {int(k) if whole and k is not None else k: t for k, t in totals.items()}
