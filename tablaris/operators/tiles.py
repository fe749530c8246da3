"""Correlations of thousands of columns, as a table that no task and no driver holds whole.

Columns are staged as blocks, an array column each. A pair of blocks is a tile of
the matrix: some tasks read just these two columns and keep the tile's moments as
products of matrices, cut into stripes of rows; stripes are merged in their own
tasks, which write their pairs as rows. Memory is that of a tile, whatever the
width, and every pair counts the rows where both columns are known.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablaris.sources.staging import stage

# Columns of a block.
BLOCK = 512
# Tasks that share the rows of one tile.
TASKS = 32
# Rows of a tile that are merged in one place.
STRIPE = 32


@dataclass(frozen=True)
class TileMoments:
    """Matrices over (column of one block, column of another): rows with both known,
    the means over them, the sums of squared deviations, and of joint ones."""

    n: np.ndarray
    mean_a: np.ndarray
    mean_b: np.ndarray
    square_a: np.ndarray
    square_b: np.ndarray
    joint: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, known_a: np.ndarray, b: np.ndarray, known_b: np.ndarray) -> TileMoments:
        """Of a batch of rows. Deviations are taken from each column's own mean first."""

        def centered(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            center = np.where(known, values, 0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
            return np.where(known, values - center, 0.0), center

        with np.errstate(invalid="ignore"):
            x, center_a = centered(a, known_a)
            y, center_b = centered(b, known_b)
            k, m = known_a.astype(float), known_b.astype(float)
            n = k.T @ m
            some = np.maximum(n, 1)
            off_a, off_b = (x.T @ m) / some, (k.T @ y) / some
            return cls(
                n,
                off_a + center_a[:, None],
                off_b + center_b,
                (x * x).T @ m - n * off_a * off_a,
                k.T @ (y * y) - n * off_b * off_b,
                x.T @ y - n * off_a * off_b,
            )

    def merge(self, other: TileMoments) -> TileMoments:
        n = self.n + other.n
        both, some = (self.n > 0) & (other.n > 0), np.maximum(n, 1)
        # A side without rows for a pair adds nothing, whatever its mean says.
        step_a, step_b = (np.where(both, theirs - own, 0.0) for own, theirs in ((self.mean_a, other.mean_a), (self.mean_b, other.mean_b)))
        weight, share = self.n * other.n / some, other.n / some
        return TileMoments(
            n,
            np.where(self.n > 0, self.mean_a + step_a * share, other.mean_a),
            np.where(self.n > 0, self.mean_b + step_b * share, other.mean_b),
            self.square_a + other.square_a + step_a * step_a * weight,
            self.square_b + other.square_b + step_b * step_b * weight,
            self.joint + other.joint + step_a * step_b * weight,
        )

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.n, self.mean_a, self.mean_b, self.square_a, self.square_b, self.joint

    def correlations(self) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.joint / np.sqrt(self.square_a * self.square_b)


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten()
    return (
        flat.to_numpy(zero_copy_only=False).reshape(-1, width),
        flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width),
    )


_STRIPES = "a int, b int, stripe int, moments binary"


def correlation_table(df: DataFrame, columns: Sequence[str], block: int = BLOCK, tasks: int = TASKS, stripe: int = STRIPE) -> DataFrame:
    """Pearson correlations, both triangles, one row per pair (variable_a, variable_b, r).

    Pairs without spread, or without rows, have NULL; a table without rows has NULL
    for all. Columns are read as doubles.
    """
    names = list(columns)
    blocks = [names[i : i + block] for i in range(0, len(names), block)]
    # Columns become blocks in Arrow: as expressions thousands of them are much generated code.
    doubles = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for i in range(0, len(names), block):
                own = batch.columns[i : i + block]
                values = np.stack([c.to_numpy(zero_copy_only=False) for c in own], axis=1)
                known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in own], axis=1)
                offsets = np.arange(len(batch) + 1, dtype=np.int32) * len(own)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), mask=~known.ravel())))
            yield pa.RecordBatch.from_arrays(lists, [f"b{i}" for i in range(len(lists))])

    schema = ", ".join(f"b{i} array<double>" for i in range(len(blocks)))
    staged = stage(df.select(*doubles).mapInArrow(pack, schema), "blocks")

    def tile(i: int, j: int) -> DataFrame:
        wide, high = len(blocks[j]), len(blocks[i])

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    rows = batch.slice(at, 1024)
                    part = TileMoments.of(*_matrix(rows.column(0), high), *_matrix(rows.column(rows.num_columns - 1), wide))
                    total = part if total is None else total.merge(part)
            if total is None:
                total = TileMoments(*np.zeros((6, high, wide)))
            for number, first in enumerate(range(0, high, stripe)):
                own = np.stack([p[first : first + stripe] for p in total.parts()])
                yield pa.RecordBatch.from_pydict({"a": pa.array([i], pa.int32()), "b": pa.array([j], pa.int32()), "stripe": pa.array([number], pa.int32()), "moments": [own.tobytes()]})

        read = staged.select(*dict.fromkeys([f"b{i}", f"b{j}"]))
        return read.coalesce(tasks).mapInArrow(gather, _STRIPES)

    stripes = reduce(DataFrame.union, [tile(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))])

    def merge(group: pa.Table) -> pa.Table:
        i, j, number = (group.column(c)[0].as_py() for c in ("a", "b", "stripe"))
        total = None
        for data in group.column("moments"):
            part = TileMoments(*np.frombuffer(data.as_buffer()).reshape(6, -1, len(blocks[j])))
            total = part if total is None else total.merge(part)
        r = total.correlations()
        high, wide = r.shape
        first = i * block + number * stripe
        a = np.repeat(np.arange(first, first + high), wide)
        b = np.tile(np.arange(j * block, j * block + wide), high)
        r = r.ravel()
        if i != j:  # the other triangle
            a, b, r = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([r, r])
        known = pa.array(names)
        return pa.table({"variable_a": known.take(pa.array(a)), "variable_b": known.take(pa.array(b)), "r": pa.array(r, mask=np.isnan(r))})

    return stripes.groupBy("a", "b", "stripe").applyInArrow(merge, "variable_a string, variable_b string, r double")
