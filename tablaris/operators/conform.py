"""Schema operators: map messy headers onto the expected columns.

Everything is decided from the header on the driver (a list of names) and
applied as one positional projection, so duplicate or clashing source names
never make a reference ambiguous and Catalyst prunes what is dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.functions.names import normalize_name
from tablaris.functions.parse import parse_double, parse_int
from tablaris.spec import CleanSpec


def column_sources(headers: Iterable[str], aliases: Mapping[str, str]) -> dict[str, int]:
    """Canonical name -> position of the first header that maps to it."""
    sources: dict[str, int] = {}
    for position, header in enumerate(headers):
        plain = normalize_name(header)
        sources.setdefault(aliases.get(plain, plain), position)
    return sources


def _positional(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def normalize_columns(
    df: DataFrame, aliases: Mapping[str, str], headers: Iterable[str] | None = None
) -> DataFrame:
    """Rename every column to its canonical name; later claimants are dropped.

    ``headers`` gives the raw header when it differs from ``df.columns`` (the
    CSV reader rewrites clashing names).
    """
    sources = column_sources(headers or df.columns, aliases)
    return _positional(df).select(*[F.col(f"_{i}").alias(name) for name, i in sources.items()])


def conform(df: DataFrame, spec: CleanSpec, headers: Iterable[str] | None = None) -> DataFrame:
    """Exactly the expected columns as trimmed text, absent ones as NULL.

    Columns named in ``spec.ingest_order`` ride along untouched.
    """
    headers = list(headers or df.columns)
    sources = column_sources(headers, spec.aliases)
    wide = _positional(df)

    def text(name: str) -> Column:
        if name not in sources:
            return F.lit(None).cast("string").alias(name)
        return F.trim(F.col(f"_{sources[name]}").cast("string")).alias(name)

    extra = [
        F.col(f"_{df.columns.index(c)}").alias(c) for c in spec.ingest_order if c not in spec.names
    ]
    return wide.select(*[text(n) for n in spec.names], *extra)


def apply_types(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Conformed text to the declared types; unreadable values become NULL.

    Typed rows leave through ``inline``: a filter on them is not pushed below
    it, where every rule would parse its text anew.
    """
    parsers = {"int": parse_int, "double": parse_double}
    typed = [
        parsers[f.kind](F.col(f.name), f.decimal_comma).alias(f.name)
        if f.kind in parsers
        else F.col(f.name)
        for f in spec.fields
    ]
    others = [c for c in df.columns if c not in spec.names]
    return df.select(F.inline(F.array(F.struct(*typed, *others))))


def required_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """One row per required column: is it there, and how many values does it hold?"""
    present = set(df.columns)
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(name in present).alias("present"),
                    (F.count(F.col(name)) if name in present else F.lit(0).cast("long")).alias(
                        "filled"
                    ),
                )
                for name in required
            ]
        ).alias("r")
    )
    return counts.select(F.inline("r"))


def final_projection(df: DataFrame, spec: CleanSpec, flags: Iterable[str]) -> DataFrame:
    """Declared columns in declared order and type, then the 0/1 flags."""
    return df.select(
        *[F.col(f.name).cast(f.data_type).alias(f.name) for f in spec.fields],
        *[F.col(c).cast("int").alias(c) for c in flags],
    )
