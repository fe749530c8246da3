"""Counts, means and co-moments of many columns in one pass.

A batch of rows becomes a matrix and its co-moments one product of matrices, so
the cost of a plan does not grow with the square of the number of columns.
Every task hands on one set of moments for each value of ``by``; a second step
merges these in a bounded number of groups, and only those reach the driver.
All figures are kept for each pair of columns over the rows where both are known.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups that partial moments are merged in, for each value of ``by``.
MERGE_GROUPS = 16


@dataclass(frozen=True)
class PairMoments:
    """Matrices over column pairs (i, j): rows with both known, mean of i over
    them, and the sums of squared and of joint deviations."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    joint: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, known: np.ndarray) -> PairMoments:
        """Of a batch of rows. Deviations are taken from each column's own mean first."""
        count = known.sum(axis=0)
        with np.errstate(invalid="ignore"):
            center = np.where(known, values, 0).sum(axis=0) / np.maximum(count, 1)
            x = np.where(known, values - center, 0.0)
            k = known.astype(float)
            n = k.T @ k
            some = np.maximum(n, 1)
            off = (x.T @ k) / some
            square = (x * x).T @ k - n * off * off
            joint = x.T @ x - n * off * off.T
        return cls(n, off + center[:, None], square, joint)

    def merge(self, other: PairMoments) -> PairMoments:
        n = self.n + other.n
        some = np.maximum(n, 1)
        # A side without rows for a pair adds nothing, whatever its mean says.
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / some
        mean = np.where(self.n > 0, self.mean + step * other.n / some, other.mean)
        return PairMoments(
            n,
            mean,
            self.square + other.square + step * step * weight,
            self.joint + other.joint + step * step.T * weight,
        )

    def correlations(self) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.joint / np.sqrt(self.square * self.square.T)

    def to_bytes(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.joint]).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, width: int) -> PairMoments:
        return cls(*np.frombuffer(data).reshape(4, width, width))


def _merged(parts: Sequence[bytes], width: int) -> PairMoments:
    total = PairMoments.from_bytes(parts[0], width)
    for part in parts[1:]:
        total = total.merge(PairMoments.from_bytes(part, width))
    return total


def pair_moments(df: DataFrame, columns: Sequence[str], by: str | None = None) -> dict[object, PairMoments]:
    """Moments of ``columns``, as doubles, for each value of ``by`` (None without it).

    ``by`` is for a column of a stated few values, such as a fold or a side of a
    split: one matrix for each of them is fetched. An empty table has no entry.
    """
    width = len(columns)
    rows = df.select(
        (F.col(by).cast("string") if by else F.lit(None).cast("string")).alias("by"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"),
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, PairMoments] = {}
        for batch in batches:
            flat = batch.column("x").flatten()
            values = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
            known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
            keys = batch.column("by").to_pylist()
            for key in set(keys):
                own = slice(None) if by is None else np.array([k == key for k in keys])
                part = PairMoments.of(values[own], known[own])
                totals[key] = totals[key].merge(part) if key in totals else part
        for key, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.string()), pa.array([total.to_bytes()], pa.binary())], ["by", "moments"]
            )

    def merge(group: pa.Table) -> pa.Table:
        total = _merged(group.column("moments").to_pylist(), width)
        return pa.table({"by": group.column("by").slice(0, 1), "moments": pa.array([total.to_bytes()], pa.binary())})

    partial = rows.mapInArrow(gather, "by string, moments binary")
    groups = partial.groupBy("by", F.pmod(F.xxhash64("moments"), F.lit(MERGE_GROUPS)))
    merged: dict[object, list[bytes]] = {}
    for row in groups.applyInArrow(merge, "by string, moments binary").orderBy("by", "moments").collect():
        merged.setdefault(row["by"], []).append(bytes(row["moments"]))
    kinds = {"int": int, "bigint": int}
    back = kinds.get(dict(df.dtypes).get(by, ""), str) if by else str
    return {None if k is None else back(k): _merged(v, width) for k, v in merged.items()}
