"""CSV source and sink."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.functions.names import normalize_name
from tablaris.operators.dedup import ingest_order
from tablaris.operators.infer import infer_types, with_types
from tablaris.sources.staging import stage, staging_path

# Bytes up to which a file is read whole to find its first line.
SMALL_FILE = 1 << 20
# Lines fetched at a time from the start of a larger one.
FIRST_LINES = 16


@dataclass(frozen=True)
class Layouts:
    """Headers of the files under a path, in the order of their first files.

    ``lines`` are the first lines that a header is written as, ``files`` how many
    files have it; ``table`` has (file, line) of every file and is not fetched.
    """

    headers: list[tuple[str, ...]]
    lines: list[list[str]]
    files: list[int]
    table: DataFrame


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the first line with anything in it of every file that has one.

    A Spark job that opens no file on the driver. Small files are single rows of a
    text scan; from a larger one, which is a task of its own, only the first lines
    are fetched, whatever its size. Sizes prune both scans when they are planned.
    """
    meta = F.col("_metadata")
    whole = spark.read.text(path, wholetext=True).where(meta["file_size"] <= SMALL_FILE)
    lines = F.split(F.ltrim("value", F.lit("\ufeff")), "[\r\n]+")
    small = whole.select(
        meta["file_path"].alias("file"), F.get(F.filter(lines, lambda line: line.rlike(r"\S")), F.lit(0)).alias("line")
    ).where("line IS NOT NULL")
    listed = spark.read.format("binaryFile").load(path)
    if listed.where(F.col("length") > SMALL_FILE).select("path").isEmpty():
        return small

    own = spark.newSession()  # with settings of its own: every file one task, few lines a batch
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, str(1 << 45))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FIRST_LINES))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in enumerate(batch.column("value").to_pylist()):
                line = value.removeprefix("\ufeff")
                if line.strip():
                    yield pa.RecordBatch.from_pydict({"file": batch.column("file").slice(i, 1), "line": pa.array([line])})
                    return

    large = own.read.text(path).where(meta["file_size"] > SMALL_FILE).select("value", meta["file_path"].alias("file"))
    found = staging_path(spark, "first-lines")
    large.mapInArrow(first, "file string, line string").write.parquet(found)
    return small.unionByName(spark.read.schema("file string, line string").parquet(found))


def csv_layouts(spark: SparkSession, path: str) -> Layouts:
    """Distinct headers under ``path``; only these reach the driver.

    Files without any line have none. A header must not hold a line break.
    """
    table = first_lines(spark, path)
    kinds = table.groupBy("line").agg(F.min("file").alias("first"), F.count("*").alias("files")).collect()
    by_header: dict[tuple[str, ...], list] = {}
    for kind in sorted(kinds, key=lambda k: k["first"]):
        by_header.setdefault(tuple(next(csv.reader([kind["line"]]))), []).append(kind)
    own = list(by_header.values())
    return Layouts(list(by_header), [[k["line"] for k in ks] for ks in own], [sum(k["files"] for k in ks) for ks in own], table)


def numbered(names: list[str] | tuple[str, ...]) -> list[tuple[str, int]]:
    """Normalized names; a repeated one is told apart by its number."""
    seen: Counter[str] = Counter()
    out = []
    for name in map(normalize_name, names):
        out.append((name, seen[name]))
        seen[name] += 1
    return out


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, order: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Rows of a headed CSV file or folder and its raw header.

    Without ``schema`` every column is text, named by position. Short rows are
    padded with NULL, surplus fields cut, blank lines skipped. Files of a folder
    may differ in their headers: columns are matched by normalized name, those
    that only later files have come after the others, and a file's missing ones
    are NULL. With ``schema``, and several headers, its columns are matched by
    name too, and what cannot be read as a column's type is NULL; with one header
    they go by position. ``order`` names an added column with each row's place in
    the files.
    """
    found = csv_layouts(spark, path)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")

    def scan(columns: T.StructType) -> DataFrame:
        rows = reader.schema(columns).csv(path)
        return rows.withColumn(order, ingest_order()) if order else rows

    def positional(width: int) -> T.StructType:
        return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])

    if len(found.headers) < 2:
        header = list(next(iter(found.headers), ()))
        return scan(schema or positional(len(header))), header

    places: dict[tuple[str, int], int] = {}
    whole: list[str] = []
    if schema is not None:
        whole = schema.fieldNames()
        places = {key: i for i, key in enumerate(numbered(whole))}
    else:
        for names in found.headers:
            for key, name in zip(numbered(names), names):
                if key not in places:
                    places[key] = len(whole)
                    whole.append(name)
    at = []
    for names in found.headers:
        where = {key: i for i, key in enumerate(numbered(names))}
        at.append([where.get(key, -1) for key in places])
    # Files are told their layout by a join on the path; those of the most frequent one need no row for it.
    usual = found.files.index(max(found.files))
    others = [(line, at[i]) for i, lines in enumerate(found.lines) if i != usual for line in lines]
    layouts = found.table.join(spark.createDataFrame(others, "line string, at array<int>"), "line").select(F.col("file").alias("_file"), "at")
    layouts = stage(layouts, "layout-files")  # so that the planner knows its size
    rows = scan(positional(max(map(len, found.headers))))
    width = [c for c in rows.columns if c != order]
    rows = rows.withColumn("_path", F.col("_metadata.file_path"))
    rows = rows.join(layouts, F.col("_path") == F.col("_file"), "left")
    values, places_of = F.array(*width), F.coalesce("at", F.array(*[F.lit(i) for i in at[usual]]))

    def column(i: int) -> Column:
        text = F.get(values, F.get(places_of, F.lit(i)))
        return text.alias(f"_c{i}") if schema is None else text.try_cast(schema[i].dataType).alias(whole[i])

    return rows.select(*[column(i) for i in range(len(whole))], *([order] if order else [])), whole


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with types found in the data, under the header's names.

    One aggregate over the raw text, so an explicit ``scan_csv`` schema is better
    wherever one is known. Of names that differ in case at most all but the
    first get their position.
    """
    rows, header = scan_csv(spark, path)
    lower = [n.lower() for n in header]
    names = [n if lower.index(n.lower()) == i else f"{n}_{i}" for i, n in enumerate(header)]
    rows = rows.toDF(*names)
    return with_types(rows, infer_types(rows)) if names else rows


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headed CSV. ``single_file`` funnels the last stage into one task: small
    results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
