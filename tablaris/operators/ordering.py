"""Row order over whole tables: positions, rank cuts, nearest known values.

A window without partition columns, or over one hot group, would put that
whole group into one task. Here a group's size is looked up first; small
groups take the plain window, larger ones are cut into range-partitioned
slices that are staged once. Windows then run per slice, and only one summary
row per slice is carried across. Each slice costs a task, a file and a hundred
sampled rows at the driver, so there are not many more of them than run at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.operators.quantiles import RANK_ROWS, order_statistics
from tablaris.sources.staging import stage

# Rows of one group that a single window task may take.
WINDOW_ROWS = 1_000_000
# Slices that a table may have whatever its size; beyond, they grow up to WINDOW_ROWS first.
SLICES = 256

_SLICE = "_slice"


@dataclass(frozen=True)
class GroupSizes:
    rows: int
    largest: int


def group_sizes(df: DataFrame, group_by: Sequence[str]) -> GroupSizes:
    """Table size and largest group, counted with map-side combining."""
    row = (
        df.groupBy(*group_by)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("rows"), F.max("n").alias("largest"))
        .first()
    )
    return GroupSizes(row["rows"] or 0, row["largest"] or 0)


def total_order(df: DataFrame, order_by: Sequence[str], group_by: Sequence[str] = ()) -> list[str]:
    """``order_by`` extended by every other column that has an order.

    Rows tied in ``order_by`` then have one place whatever their layout; rows
    equal in everything are interchangeable.
    """
    fixed = {*order_by, *group_by}
    unordered = ("map", "variant", "interval")
    kinds = dict(df.dtypes)
    return [*order_by, *[c for c in df.columns if c not in fixed and not any(u in kinds[c] for u in unordered)]]


def slice_count(rows: int, window_rows: int, partitions: int) -> int:
    """Slices of ``window_rows`` rows, or of more, up to WINDOW_ROWS, where that would be too many.

    Too many is over SLICES and over ``partitions``, the tasks of a shuffle.
    """
    enough = max(SLICES, partitions, math.ceil(rows / max(WINDOW_ROWS, window_rows)))
    return max(2, min(math.ceil(rows / window_rows), enough))


def _slices(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], rows: int, window_rows: int
) -> DataFrame:
    """Staged copy cut into contiguous ranges of (group, order)."""
    count = slice_count(rows, window_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(count, *group_by, *order_by)
    return stage(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def _listed(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _spanning(summary: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Summary rows of groups that reach over more than one slice.

    Each slice holds the tail of at most one group, whole groups, and the head
    of at most one, so at most two rows per slice remain.
    """
    whole = Window.partitionBy(*group_by)
    spans = F.min(_SLICE).over(whole) < F.max(_SLICE).over(whole)
    return summary.withColumn("_spans", spans).where("_spans").drop("_spans")


def _attach(sliced: DataFrame, carry: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Join the slice summary back, NULL groups matching themselves.

    The summary has at most two rows a slice; whether that is broadcast or
    shuffled is left to the sizes found when it runs.
    """
    keys = [*group_by, _SLICE]
    renamed = carry.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in carry.columns if c not in keys]
    )
    on = F.col(_SLICE) == F.col(f"_k_{_SLICE}")
    for k in group_by:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return sliced.join(renamed, on, "left").drop(*[f"_k_{k}" for k in keys])


def neighbours(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    sizes: GroupSizes | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add, per column, the last known value up to and the first from each row.

    The additions are named ``_prev_<c>`` and ``_next_<c>``. Rows tied in
    ``order_by`` go by their other columns, NULLs first, in one total order that
    both directions follow.
    """
    order_by = total_order(df, order_by, group_by)
    sizes = sizes or group_sizes(df, group_by)
    sliced = sizes.largest > window_rows
    if sliced:
        df = _slices(df, group_by, order_by, sizes.rows, window_rows)
    keys = [*group_by, *([_SLICE] if sliced else [])]
    upto = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A frame reaching to the end of the partition is evaluated anew for every row, in
    # quadratic time; the next known value is found in the same pass, in the same order.
    spec = " ".join([*(["PARTITION BY " + _listed(keys)] if keys else []), "ORDER BY " + _listed(order_by)])
    seen = df.select(
        "*",
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_prev_{c}") for c in columns],
        *[F.coalesce(c, F.expr(f"lead(`{c}`, 1) IGNORE NULLS OVER ({spec})")).alias(f"_next_{c}") for c in columns],
    )
    if not sliced:
        return seen

    place = F.struct(*order_by)
    known = {c: F.when(F.col(c).isNotNull(), place) for c in columns}
    edges = df.groupBy(*group_by, _SLICE).agg(
        *[F.max_by(c, known[c]).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, known[c]).alias(f"_first_{c}") for c in columns],
    )
    across = Window.partitionBy(*group_by)
    earlier = across.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    later = across.orderBy(F.desc(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carry = _spanning(edges, group_by).select(
        *group_by,
        _SLICE,
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_after_{c}") for c in columns],
    )
    joined = _attach(seen, carry, group_by)
    kept = [c for c in df.columns if c != _SLICE]
    return joined.select(
        *kept,
        *[F.coalesce(f"_prev_{c}", f"_before_{c}").alias(f"_prev_{c}") for c in columns],
        *[F.coalesce(f"_next_{c}", f"_after_{c}").alias(f"_next_{c}") for c in columns],
    )


def row_positions(
    df: DataFrame,
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    out: str = "position",
    sizes: GroupSizes | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the 1-based position of each row within its group, ties as in :func:`neighbours`."""
    order_by = total_order(df, order_by, group_by)
    sizes = sizes or group_sizes(df, group_by)
    sliced = sizes.largest > window_rows
    if not sliced:
        window = Window.partitionBy(*group_by).orderBy(*order_by)
        return df.withColumn(out, F.row_number().over(window).cast("long"))

    df = _slices(df, group_by, order_by, sizes.rows, window_rows)
    window = Window.partitionBy(*group_by, _SLICE).orderBy(*order_by)
    earlier = (
        Window.partitionBy(*group_by)
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = df.groupBy(*group_by, _SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = _spanning(counted, group_by).select(
        *group_by, _SLICE, F.sum("_rows").over(earlier).alias("_offset")
    )
    placed = _attach(df.withColumn(out, F.row_number().over(window)), offsets, group_by)
    offset = F.coalesce("_offset", F.lit(0))
    return placed.withColumn(out, F.col(out) + offset).drop("_offset", _SLICE)


def cut_by_rank(
    df: DataFrame,
    order_by: Sequence[str],
    ranks: Callable[[int], Sequence[int]],
    out: str,
    window_rows: int = WINDOW_ROWS,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """Number the stretches that the given ranks cut the ordered table into.

    A row's ``out`` is how many of the ranks lie before its position. The
    first order column, a number, is cut by its exact order statistics, so no
    row is shuffled or sorted; only rows tied with a cut value are ranked by the
    remaining columns. Dates and timestamps count as numbers; for any other type
    the rows are positioned in slices. Rows without a first column have no
    position: they stay, with NULL for ``out``.
    """
    lead, *rest = order_by
    kind = df.schema[lead].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        number = F.unix_date(lead) if isinstance(kind, T.DateType) else F.unix_micros(F.col(lead).cast("timestamp"))
        numbered = df.withColumn("_lead", number.cast("long"))
        return cut_by_rank(numbered, ["_lead", *rest], ranks, out, window_rows, rank_rows).drop("_lead")
    if not isinstance(kind, T.NumericType):
        known = df.where(F.col(lead).isNotNull())
        rows = known.count()
        placed = row_positions(known, order_by, out="_position", sizes=GroupSizes(rows, rows), window_rows=window_rows)
        before = sum(((F.col("_position") > r).cast("int") for r in ranks(rows)), F.lit(0))
        placed = placed.withColumn(out, before).drop("_position")
        return placed.unionByName(df.where(F.col(lead).isNull()).withColumn(out, F.lit(None).cast("int")))

    def inside(n: int) -> list[int]:
        # Rank 0 cuts before everything and rank n after: neither needs a value.
        return [r for r in ranks(n) if 0 < r < n]

    n, stats = order_statistics(df, {lead: inside}, rank_rows)[lead]
    inner = inside(n)
    always = sum(r <= 0 for r in ranks(n))
    cuts = list(zip(inner, stats))
    shared = {s.value: s.equal for r, s in cuts if s.below + s.equal != r}
    if shared and not rest:
        raise ValueError(f"rows tied on {lead} straddle a cut: order by more columns")

    col = F.col(lead)
    above = sum(((col > s.value).cast("int") for _, s in cuts), F.lit(always))
    if not shared:
        return df.withColumn(out, above)

    tied = row_positions(
        df.where(col.isin(list(shared))),
        rest,
        [lead],
        "_tie",
        GroupSizes(sum(shared.values()), max(shared.values())),
        window_rows,
    )
    beyond = sum(
        (
            ((col == s.value) & (F.col("_tie") > r - s.below)).cast("int")
            for r, s in cuts
            if s.value in shared
        ),
        above,
    )
    clear = df.where(~F.coalesce(col.isin(list(shared)), F.lit(False))).withColumn(out, above)
    return clear.unionByName(tied.withColumn(out, beyond).drop("_tie"))
