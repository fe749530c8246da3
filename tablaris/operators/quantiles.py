"""Exact order statistics and quantiles without sorting or gathering a column.

``order_statistics`` is a distributed selection. A sketch, merged in two levels
so that no task takes in more than a few hundred of them, proposes two pivots
around each wanted rank; one aggregate counts the rows below, between and on
the pivots; the search goes on in the part that holds the rank. Once a part is
small, its values are sorted in one place. The pivots only steer: the counts
decide, so the answer does not depend on the sketch's accuracy. Where the parts
of all columns together are more than one task should hold, their values become
rows (part, value) that are ranked in partitions of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A part with at most this many rows is sorted directly, as one array.
RANK_ROWS = 100_000
# In a part of up to this many times as many rows, what lies between the pivots
# is sorted in the same pass that counts around them. That is about a 250th of
# the part, and the whole part at worst. Measured: with more than a few such
# lists the aggregate takes longer than two passes do.
ONE_PASS = 16
# Values that one task may sort as arrays, over all parts; beyond, parts are ranked as rows.
TASK_VALUES = 400_000
# Columns whose searches share passes; more are done so many at a time, each reading its own.
COLUMNS = 40
ONE_PASS_LISTS = 4
SKETCH_SIZE = 4096
SKETCH_FAN_IN = 256
# How far, as a share of the rows, the pivots stand from the wanted rank: a few
# times the error of a sketch of this size.
PIVOT_REACH = 0.002
# Stand-in for a row count not known yet when a rank is turned into a share.
NOTIONAL_ROWS = 1_000_000_000

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class OrderStatistic:
    """A value, the rows strictly below it and the rows equal to it."""

    value: Any
    below: int
    equal: int


@dataclass
class _Search:
    """One wanted rank and the open interval ``(low, high)`` still holding it.

    ``rows`` lie in the interval and ``below`` on its left, ``low`` included.
    """

    column: str
    rank: int
    rows: int
    low: Any = None
    high: Any = None
    below: int = 0
    found: OrderStatistic | None = None

    @property
    def share(self) -> float:
        """Where the rank lies within the part's rows, from 0 to 1."""
        return (self.rank - self.below) / max(1, self.rows)

    @property
    def part(self) -> tuple[str, Any, Any]:
        return self.column, self.low, self.high

    def inside(self) -> Column:
        col = F.col(self.column)
        test = col.isNotNull()
        if self.low is not None:
            test &= col > self.low
        if self.high is not None:
            test &= col < self.high
        return test



def _is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _INTEGRAL)


def _any(tests: Sequence[Column]) -> Column:
    return reduce(Column.__or__, tests)


def _survey(df: DataFrame, searches: Sequence[_Search]) -> list[tuple[int, int, Any, Any]]:
    """Per search: rows of its part, rows that are not NaN, and two pivots.

    Parts shared by several searches are sketched once.
    """
    parts = {s.part: s for s in searches}
    name = {part: f"s{i}" for i, part in enumerate(parts)}
    size = F.lit(SKETCH_SIZE)
    sketches = []
    for part, s in parts.items():
        col = F.col(s.column)
        if _is_integral(df, s.column):
            sketch = F.kll_sketch_agg_bigint(F.when(s.inside(), col.cast("long")), size)
        else:
            sane = s.inside() & ~F.isnan(col)
            sketch = F.kll_sketch_agg_double(F.when(sane, col.cast("double")), size)
        sketches += [sketch.alias(name[part]), F.count_if(s.inside()).alias(f"n_{name[part]}")]

    merged = []
    for i, s in enumerate(searches):
        whole = _is_integral(df, s.column)
        merge = F.kll_merge_agg_bigint if whole else F.kll_merge_agg_double
        number = F.kll_sketch_get_n_bigint if whole else F.kll_sketch_get_n_double
        quantile = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
        sketch = merge(F.col(name[s.part]), size)
        around = [max(0.0, s.share - PIVOT_REACH), min(1.0, s.share + PIVOT_REACH)]
        merged.append(
            F.struct(
                F.coalesce(F.sum(f"n_{name[s.part]}"), F.lit(0)),
                F.coalesce(number(sketch), F.lit(0)),
                F.when(number(sketch) > 0, quantile(sketch, F.lit(around))),
            ).alias(f"r{i}")
        )
    fan = F.pmod(F.spark_partition_id(), F.lit(SKETCH_FAN_IN)).alias("_fan")
    row = df.groupBy(fan).agg(*sketches).agg(*merged).first()
    return [(n, sane, *(pivots or (None, None))) for n, sane, pivots in row]


def _count_around(
    df: DataFrame, pivots: Sequence[tuple[_Search, Any, Any]], rank_rows: int
) -> list[tuple]:
    """Per search: rows of its column below, up to each of the two pivots, and,
    in a part small enough, the statistic itself if it lies between them."""
    tests: dict[tuple, str] = {}
    for s, low, high in pivots:
        for pivot in (low, high):
            for strict in (True, False):
                tests.setdefault((s.column, pivot, strict), f"t{len(tests)}")
    counts = [
        F.count_if(F.col(c) < pivot if strict else F.col(c) <= pivot).alias(name)
        for (c, pivot, strict), name in tests.items()
    ]
    lists: dict[tuple, str] = {}
    for s, low, high in pivots:
        if s.rows <= rank_rows * ONE_PASS and low < high:
            lists.setdefault((s.column, low, high), f"l{len(lists)}")
    if len(lists) > ONE_PASS_LISTS:
        lists = {}
    between = [
        F.sort_array(
            F.collect_list(F.when((F.col(c) > low) & (F.col(c) < high), F.col(c)))
        ).alias(name)
        for (c, low, high), name in lists.items()
    ]

    def found(s: _Search, low: Any, high: Any) -> Column:
        name = lists.get((s.column, low, high))
        if name is None:
            return F.lit(None)
        upto_low = F.col(tests[s.column, low, False])
        return _statistic(F.col(name), F.lit(s.rank) - upto_low, upto_low)

    row = (
        df.agg(*counts, *between)
        .select(*tests.values(), *[found(*p).alias(f"f{i}") for i, p in enumerate(pivots)])
        .first()
    )
    return [
        (
            *(row[tests[s.column, p, strict]] for p in (low, high) for strict in (True, False)),
            row[f"f{i}"],
        )
        for i, (s, low, high) in enumerate(pivots)
    ]


def _statistic(ordered: Column, position: Column, below: Column) -> Column:
    """Value at a 1-based position of a sorted array, NULL if there is none,
    with the rows below it (``below`` of them left of the array) and equal to it."""
    there = (position >= 1) & (position <= F.size(ordered))
    value = F.get(ordered, (position - 1).cast("int"))
    return F.when(
        there,
        F.struct(
            value.alias("value"),
            (below + F.array_position(ordered, value) - 1).alias("below"),
            F.size(F.filter(ordered, lambda v: v == value)).alias("equal"),
        ),
    )


def _advance(search: _Search, low: Any, high: Any, counts: tuple) -> None:
    """Settle the search on a pivot or move it to the part between the right two."""
    under_low, upto_low, under_high, upto_high, between = counts
    if search.rank <= under_low:
        search.high, search.rows = low, under_low - search.below
    elif search.rank <= upto_low:
        search.found = OrderStatistic(low, under_low, upto_low - under_low)
    elif between is not None:
        search.found = OrderStatistic(*between)
    elif search.rank <= under_high:
        search.low, search.high = low, high
        search.below, search.rows = upto_low, under_high - upto_low
    elif search.rank <= upto_high:
        search.found = OrderStatistic(high, under_high, upto_high - under_high)
    else:
        search.rows -= upto_high - search.below
        search.low, search.below = high, upto_high


def _rank_rows(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Rank the values of each part in partitions of its own, equal ones as one row."""
    parts = {s.part: (i, s) for i, s in enumerate(searches)}
    by_type: dict[str, list[tuple[int, _Search]]] = {}
    for i, s in parts.values():
        by_type.setdefault(df.schema[s.column].dataType.simpleString(), []).append((i, s))
    for own in by_type.values():
        values = F.array(*[F.when(s.inside(), F.struct(F.lit(i).alias("part"), F.col(s.column).alias("value"))) for i, s in own])
        rows = df.where(_any([s.inside() for _, s in own])).select(F.explode(F.filter(values, lambda v: v.isNotNull())).alias("v"))
        counted = rows.groupBy(F.col("v.part").alias("part"), F.col("v.value").alias("value")).agg(F.count(F.lit(1)).alias("equal"))
        order = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counted.withColumn("upto", F.sum("equal").over(order))
        inside = {i for i, _ in own}
        asked = [(k, parts[s.part][0], s.rank - s.below) for k, s in enumerate(searches) if parts[s.part][0] in inside]
        wanted = df.sparkSession.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*asked), (pa.int32(), pa.int32(), pa.int64()))], ["search", "part", "rank"]))
        hit = placed.join(wanted, "part").where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("equal")))
        for row in hit.select("search", "value", "upto", "equal").collect():
            s = searches[row["search"]]
            s.found = OrderStatistic(row["value"], s.below + row["upto"] - row["equal"], row["equal"])


def _rank_directly(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Sort the values of each part, known to be few, and read off the ranks."""
    parts = {s.part: s for s in searches}
    if sum(s.rows for s in parts.values()) > TASK_VALUES:
        return _rank_rows(df, searches)
    name = {part: f"v{i}" for i, part in enumerate(parts)}
    values = [
        F.sort_array(F.collect_list(F.when(s.inside(), F.col(s.column)))).alias(name[part])
        for part, s in parts.items()
    ]
    lists = df.where(_any([s.inside() for s in parts.values()])).agg(*values)

    found = lists.select(
        *[
            _statistic(F.col(name[s.part]), F.lit(s.rank - s.below), F.lit(s.below)).alias(f"r{i}")
            for i, s in enumerate(searches)
        ]
    ).first()
    for s, statistic in zip(searches, found):
        s.found = OrderStatistic(*statistic)


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Callable[[int], Sequence[int]]],
    rank_rows: int = RANK_ROWS,
) -> dict[str, tuple[int, list[OrderStatistic]]]:
    """Values at given 1-based ranks of numeric columns, NULLs left out.

    ``ranks`` maps a column to a function of its non-NULL row count. Returns
    that count and one statistic per rank. NaN sorts above everything. Runs a
    few aggregate jobs that share passes across all columns and ranks.
    """
    if len(ranks) > COLUMNS:
        names = list(ranks)
        chunks = [names[i : i + COLUMNS] for i in range(0, len(names), COLUMNS)]
        return {c: v for own in chunks for c, v in order_statistics(df, {c: ranks[c] for c in own}, rank_rows).items()}
    # The first survey runs before any row count is known: ranks are taken as
    # shares of a notional table, which is all the sketch is asked for.
    trial = {
        c: [_Search(c, r, NOTIONAL_ROWS) for r in of(NOTIONAL_ROWS) or [NOTIONAL_ROWS // 2]]
        for c, of in ranks.items()
    }
    seen = iter(_survey(df, [s for part in trial.values() for s in part]))
    guesses = {c: [next(seen) for _ in part] for c, part in trial.items()}
    sizes = {c: found[0][0] for c, found in guesses.items()}
    wanted = {c: list(of(sizes[c])) if sizes[c] else [] for c, of in ranks.items()}
    searches: dict[tuple[str, int], _Search] = {}
    waiting = []
    for column, found in wanted.items():
        for i, rank in enumerate(found):
            if not 1 <= rank <= sizes[column]:
                raise ValueError(f"rank {rank} outside 1..{sizes[column]} for {column}")
            if (column, rank) not in searches:
                search = searches[column, rank] = _Search(column, rank, sizes[column])
                guess = guesses[column][min(i, len(guesses[column]) - 1)]
                waiting.append((search, guess))

    while True:
        pivots = []
        for s, (rows, sane, low, high) in waiting:
            if s.rows <= rank_rows:
                continue
            if s.rank - s.below > sane:
                s.found = OrderStatistic(math.nan, s.below + sane, rows - sane)
            else:
                pivots.append((s, low, high))
        if not pivots:
            break
        for (s, low, high), counts in zip(pivots, _count_around(df, pivots, rank_rows)):
            _advance(s, low, high, counts)
        large = [s for s, _ in waiting if s.found is None and s.rows > rank_rows]
        waiting = list(zip(large, _survey(df, large))) if large else []

    open_searches = [s for s in searches.values() if s.found is None]
    if open_searches:
        _rank_directly(df, open_searches)
    return {
        column: (sizes[column], [searches[column, rank].found for rank in found])
        for column, found in wanted.items()
    }


def _exact(p: float) -> Fraction:
    return Fraction(p).limit_denominator(10**9)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    mode: str = "exact",
    accuracy: int = 10_000,
    rank_rows: int = RANK_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles that are values of the column: the ``ceil(p * n)``-th smallest.

    ``mode='approx'`` takes Spark's sketch instead, off by at most
    ``n / accuracy`` ranks, in one aggregate. A column without values gives
    ``None`` for every probability.
    """
    if mode == "approx":
        found = df.agg(
            *[F.percentile_approx(c, list(probabilities), accuracy).alias(c) for c in columns]
        ).first()
        return {c: found[c] or [None] * len(probabilities) for c in columns}

    def rank_of(n: int) -> list[int]:
        return [max(1, math.ceil(_exact(p) * n)) for p in probabilities]

    found = order_statistics(df, {c: rank_of for c in columns}, rank_rows)
    return {
        c: [s.value for s in stats] if n else [None] * len(probabilities)
        for c, (n, stats) in found.items()
    }


def interpolated_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    rank_rows: int = RANK_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between the two nearest values."""

    def spots(n: int) -> list[Fraction]:
        return [_exact(p) * (n - 1) for p in probabilities]

    def rank_of(n: int) -> list[int]:
        return [r for s in spots(n) for r in (math.floor(s) + 1, math.ceil(s) + 1)]

    found = order_statistics(df, {c: rank_of for c in columns}, rank_rows)
    result: dict[str, list[float | None]] = {}
    for c, (n, stats) in found.items():
        pairs = zip(stats[::2], stats[1::2], spots(n)) if n else []
        result[c] = [
            float(lo.value) + (float(hi.value) - float(lo.value)) * float(s - math.floor(s))
            for lo, hi, s in pairs
        ] or [None] * len(probabilities)
    return result


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    mode: str = "exact",
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """One row per column and probability."""
    found = quantiles(df, columns, probabilities, mode, rank_rows=rank_rows)
    rows = [
        (c, float(p), None if v is None else float(v))
        for c in columns
        for p, v in zip(probabilities, found[c])
    ]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
