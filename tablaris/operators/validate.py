"""Declarative row rules, compiled to one boolean expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.functions.parse import is_finite
from tablaris.spec import CleanSpec, Rule


def rule_holds(rule: Rule) -> Column:
    col = F.col(rule.column)
    checks = [col.isNotNull()]
    if rule.low is not None:
        checks.append(col > rule.low if rule.low_open else col >= rule.low)
    if rule.high is not None:
        checks.append(col < rule.high if rule.high_open else col <= rule.high)
    # Never NULL: for a NULL value the first test alone makes it false. Plain
    # conjunctions like this one reach a Parquet scan.
    return reduce(Column.__and__, checks)


def is_valid(rules: Sequence[Rule], finite: Sequence[str] = ()) -> Column:
    """True where every rule holds and no ``finite`` column is NaN or infinite."""
    checks = [rule_holds(r) for r in rules] + [is_finite(F.col(c)) for c in finite]
    return reduce(Column.__and__, checks, F.lit(True))


def spec_validity(spec: CleanSpec) -> Column:
    """No required column is NULL, its rules hold, doubles are finite."""
    required = [f for f in spec.fields if f.required]
    names = {f.name for f in required}
    ruled = {r.column for r in spec.rules}
    rules = [Rule(f.name) for f in required if f.name not in ruled] + [r for r in spec.rules if r.column in names]
    doubles = [f.name for f in required if f.kind == "double"]
    return is_valid(rules, doubles if spec.reject_non_finite else ())


def blank_invalid(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Values of optional columns that break a rule, or are not finite, become NULL."""
    checks = {}
    for f in spec.fields:
        if not f.required:
            finite = [f.name] if f.kind == "double" and spec.reject_non_finite else []
            good = is_valid([r for r in spec.rules if r.column == f.name], finite)
            checks[f.name] = F.when(good, F.col(f.name))
    return df.withColumns(checks) if checks else df


def keep_valid(df: DataFrame, rules: Sequence[Rule], finite: Sequence[str] = ()) -> DataFrame:
    return df.where(is_valid(rules, finite))


def validity_counts(df: DataFrame, valid: Column) -> DataFrame:
    """Total, valid and invalid rows from a single pass."""
    return df.agg(
        F.count(F.lit(1)).alias("typed_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("invalid_rows"),
    )


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL in any of ``columns`` (all columns by default)."""
    return df.na.drop("any", subset=list(columns) if columns else None)
