"""Cleaning: raw rows in, clean table and quality report out.

Conform, type, validate, deduplicate, fill gaps, impute, cap. Raw rows are read
and parsed once: what is staged are the deduplicated rows, each with the number
of raw rows it stands for, and one row that stands for all invalid ones, so the
report's counts are sums over the staged table, and right also where tasks ran
more than once. It is staged once more if values were imputed; every statistic
reads single columns of these tables. Validation leaves NULLs in optional columns
only, so imputation concerns those and inserted keys, and is skipped where there
are neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.operators.conform import apply_types, conform, final_projection
from tablaris.operators.dedup import ingest_order
from tablaris.operators.gapfill import fill_gaps
from tablaris.operators.impute import Survey, impute
from tablaris.operators.ordering import WINDOW_ROWS, GroupSizes
from tablaris.operators.outliers import Fence, iqr_fences, winsorize
from tablaris.operators.validate import blank_invalid, spec_validity
from tablaris.sources.csv import scan_csv, write_csv
from tablaris.sources.staging import stage
from tablaris.sources.tables import read_parquet, write_parquet, write_report
from tablaris.spec import CleanSpec, Labels

_INGEST = "_ingest"
_VALID, _ROWS = "_valid", "_rows"


@dataclass(frozen=True)
class CleanResult:
    """The clean table (lazy) and what is needed to report on it."""

    data: DataFrame
    spec: CleanSpec
    raw_rows: int
    valid_rows: int
    base_rows: int
    key_range: tuple[int | None, int | None]
    inserted: int
    fences: dict[str, Fence | None]

    def report(self, written: DataFrame | None = None) -> DataFrame:
        """One-row quality report; one aggregate, which does not read the raw rows.

        ``written`` is the clean table read back from a sink, if there is one:
        its figures are then counted there instead of being computed again.
        """
        return _report_row(self, _final_counts(self.data if written is None else written, self.spec))


def with_ingest_order(df: DataFrame, spec: CleanSpec) -> tuple[DataFrame, CleanSpec]:
    """Give a keyed table without a stated order its order in the source files."""
    if spec.key is None or spec.ingest_order:
        return df, spec
    try:
        ordered = df.withColumn(_INGEST, ingest_order())
    except AnalysisException:  # not a file scan: the order of the partitions has to do
        ordered = df.withColumn(_INGEST, F.monotonically_increasing_id())
    return ordered, replace(spec, ingest_order=(_INGEST,))


def typed_rows(raw: DataFrame, spec: CleanSpec, headers: Sequence[str] | None) -> DataFrame:
    return blank_invalid(apply_types(conform(raw, spec, headers), spec), spec)


def combined(typed: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row for each key, or for each distinct row, with ``_rows``, the rows it stands for.

    Of a key the first row in ``ingest_order`` is kept. Invalid rows are one row,
    with NULLs and a false ``_valid``. Each task combines its rows before the shuffle.
    """
    valid = spec_validity(spec)
    if spec.key is None:
        flagged = typed.select(valid.alias(_VALID), *[F.when(valid, F.col(c)).alias(c) for c in spec.names])
        return flagged.groupBy(_VALID, *spec.names).agg(F.count(F.lit(1)).alias(_ROWS))
    flagged = typed.select(
        valid.alias(_VALID),
        F.when(valid, F.col(spec.key)).alias("_key"),
        F.when(valid, F.struct(*spec.names)).alias("_row"),
        F.struct(*spec.ingest_order).alias("_place"),
    )
    first = flagged.groupBy(_VALID, "_key").agg(F.min_by("_row", "_place").alias("_row"), F.count(F.lit(1)).alias(_ROWS))
    return first.select(_VALID, _ROWS, "_row.*")


def clean(
    raw: DataFrame,
    spec: CleanSpec,
    headers: Sequence[str] | None = None,
    quantile_mode: str = "exact",
    window_rows: int = WINDOW_ROWS,
) -> CleanResult:
    """Run the cleaning chain described by ``spec``.

    Columns of ``spec.impute`` that are not required are imputed inside
    ``spec.group_by``; filled gaps belong to no group, so a spec cannot have both.
    """
    if spec.fill_gaps and spec.group_by:
        raise ValueError("inserted keys belong to no group: fill_gaps and group_by exclude each other")
    headers = list(headers or raw.columns)
    raw, spec = with_ingest_order(raw, spec)
    typed = typed_rows(raw, spec, headers)
    staged = stage(combined(typed, spec), "deduplicated")
    base = staged.where(_VALID).select(*spec.names)
    ends = [F.min(spec.key), F.max(spec.key)] if spec.fill_gaps else [F.lit(None), F.lit(None)]
    low, high, rows, raw_rows, valid_rows = staged.agg(
        *ends, F.count_if(_VALID), F.coalesce(F.sum(_ROWS), F.lit(0)), F.coalesce(F.sum(F.when(F.col(_VALID), F.col(_ROWS))), F.lit(0))
    ).first()
    labels, inserted = spec.labels, 0
    if spec.fill_gaps and rows:
        inserted = high - low + 1 - rows
    optional = [f.name for f in spec.fields if f.name in spec.impute and not f.required]
    if inserted or optional:
        source, survey = base, None
        if inserted:
            source = fill_gaps(base, spec.key, labels.inserted, (low, high))
            span = GroupSizes(rows + inserted, rows + inserted)
            survey = None if optional else Survey(span, tuple(spec.impute), ())
        elif spec.fill_gaps:
            source = base.withColumn(labels.inserted, F.lit(0))
        whole = impute(
            source, spec.impute, spec.order_by, spec.group_by, labels.imputed, window_rows, survey
        )
        whole = stage(whole, "imputed")
    else:
        flags = [f"{labels.imputed}{c}" for c in spec.impute]
        flags = [labels.inserted, *flags] if spec.fill_gaps else flags
        whole = base.select("*", *[F.lit(0).alias(f) for f in flags])

    fences = iqr_fences(whole, spec.cap, quantile_mode, spec.fence)
    capped = winsorize(whole, fences, labels.outlier)
    data = in_order(final_projection(capped, spec, _flags(spec)), spec)
    return CleanResult(data, spec, raw_rows, valid_rows, rows, (low, high), inserted, fences)


def in_order(data: DataFrame, spec: CleanSpec) -> DataFrame:
    """Sorted as the spec asks, ties by the other columns.

    A range partition takes all rows of one sort key; with the rest of the row
    in the key, rows that share a frequent value still spread over tasks.
    """
    if not spec.sort_by:
        return data
    return data.orderBy(*spec.sort_by, *[c for c in data.columns if c not in spec.sort_by])


def _flags(spec: CleanSpec) -> list[str]:
    labels = spec.labels
    return [
        *([labels.inserted] if spec.fill_gaps else []),
        *[f"{labels.imputed}{c}" for c in spec.impute],
        *[f"{labels.outlier}{c}" for c in spec.cap],
    ]


def _final_counts(data: DataFrame, spec: CleanSpec) -> dict[str, int]:
    labels = spec.labels
    return (
        data.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.impute],
            *[F.count_if(F.col(f"{labels.imputed}{c}") == 1).alias(f"imp_{c}") for c in spec.impute],
            *[F.count_if(F.col(f"{labels.outlier}{c}") == 1).alias(f"out_{c}") for c in spec.cap],
        )
        .first()
        .asDict()
    )


def report_schema(spec: CleanSpec) -> str:
    n: Labels = spec.labels
    limits = f"{n.detected}: bigint, {n.low_limit}: double, {n.high_limit}: double"
    gaps = [f"{n.key_range} struct<min: bigint, max: bigint>", f"{n.filled} bigint"]
    return ", ".join(
        [
            f"{n.raw_rows} bigint",
            f"{n.typed_rows} bigint",
            f"{n.invalid_rows} bigint",
            f"{n.duplicates} bigint",
            *(gaps if spec.fill_gaps else []),
            f"{n.nulls_before} map<string, bigint>",
            f"{n.nulls_after} map<string, bigint>",
            f"{n.imputations} map<string, bigint>",
            f"{n.outliers} map<string, struct<{limits}>>",
            f"{n.final_rows} bigint",
        ]
    )


def _report_row(result: CleanResult, final: dict) -> DataFrame:
    spec = result.spec
    limits = {
        c: (final[f"out_{c}"], f.low if f else None, f.high if f else None)
        for c, f in result.fences.items()
    }
    gaps = [result.key_range, result.inserted] if spec.fill_gaps else []
    row = (
        result.raw_rows,
        result.raw_rows,
        result.raw_rows - result.valid_rows,
        result.valid_rows - result.base_rows,
        *gaps,
        {c: final[f"imp_{c}"] for c in spec.impute},
        {c: final[f"null_{c}"] for c in spec.impute},
        {c: final[f"imp_{c}"] for c in spec.impute},
        limits,
        final["rows"],
    )
    return result.data.sparkSession.createDataFrame([row], report_schema(spec))


def clean_csv(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    report_path: str,
    spec: CleanSpec,
    single_csv: bool = False,
    quantile_mode: str = "exact",
) -> CleanResult:
    """CSV in; ``parquet`` and ``csv`` folders and a JSON report out.

    Both sinks are written from one sort, so the files of either, in the order of
    their names, hold the rows in order. Returns the result with ``data`` read
    from the Parquet sink.
    """
    by_place = spec.key is not None and not spec.ingest_order
    raw, header = scan_csv(spark, input_path, order=_INGEST if by_place else None)
    result = clean(raw, replace(spec, ingest_order=(_INGEST,)) if by_place else spec, header, quantile_mode)
    # Blocks on executors' disks: one that is lost is sorted again from the staged table.
    ordered = result.data.persist(StorageLevel.DISK_ONLY)
    try:
        write_parquet(ordered, f"{output_dir}/parquet")
        write_csv(ordered, f"{output_dir}/csv", single_csv)
    finally:
        ordered.unpersist()
    written = read_parquet(spark, f"{output_dir}/parquet")
    paths = [
        F.lit(value).alias(name)
        for name, value in (
            ("input_path", input_path),
            ("output_parquet", f"{output_dir}/parquet"),
            ("output_csv", f"{output_dir}/csv"),
        )
    ]
    write_report(result.report(written).select("*", *paths), report_path)
    return replace(result, data=in_order(written, spec))
