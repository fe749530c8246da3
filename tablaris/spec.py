"""Declarative description of a table: what it should hold and how to clean it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


@dataclass(frozen=True)
class Field:
    """A column of the clean table and the header names it may arrive under."""

    name: str
    kind: str = "double"
    aliases: tuple[str, ...] = ()
    decimal_comma: bool = True
    # Not required: an unreadable or forbidden value becomes NULL and the row stays.
    required: bool = True

    @property
    def data_type(self) -> T.DataType:
        return _TYPES[self.kind]


@dataclass(frozen=True)
class Rule:
    """Allowed range of one column; NULL never passes."""

    column: str
    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_open: bool = False


@dataclass(frozen=True)
class Labels:
    """Names of the flag columns and of the report's fields."""

    inserted: str = "inserted"
    imputed: str = "imputed_"
    outlier: str = "outlier_"
    raw_rows: str = "raw_rows"
    typed_rows: str = "typed_rows"
    invalid_rows: str = "invalid_rows"
    duplicates: str = "duplicates_removed"
    key_range: str = "key_range"
    filled: str = "keys_filled"
    nulls_before: str = "nulls_before"
    nulls_after: str = "nulls_after"
    imputations: str = "imputations"
    outliers: str = "outliers"
    detected: str = "detected"
    low_limit: str = "low_limit"
    high_limit: str = "high_limit"
    final_rows: str = "final_rows"


@dataclass(frozen=True)
class CleanSpec:
    """How one table is cleaned.

    ``key`` set: the first row per key in ``ingest_order`` survives. ``key``
    unset: exact duplicates are removed. ``fill_gaps`` inserts the missing
    integer keys. ``impute`` columns take their neighbours' mean in
    ``order_by`` order inside ``group_by``; ``cap`` columns are limited to the
    interquartile fences.
    """

    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    key: str | None = None
    ingest_order: tuple[str, ...] = ()
    fill_gaps: bool = False
    impute: tuple[str, ...] = ()
    group_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    cap: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    reject_non_finite: bool = True
    fence: float = 1.5
    labels: Labels = field(default_factory=Labels)

    def optional(self, *columns: str) -> CleanSpec:
        """The same cleaning, with missing values in ``columns`` to be imputed, not rejected."""
        fields = tuple(replace(f, required=f.required and f.name not in columns) for f in self.fields)
        return replace(self, fields=fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def aliases(self) -> dict[str, str]:
        """Normalized header name -> canonical name."""
        return {a: f.name for f in self.fields for a in (f.name, *f.aliases)}
