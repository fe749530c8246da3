"""Types of text columns, from one aggregate over the raw text.

Every value is the set of types that can hold it, as bits, and the types of a
column are the intersection of these sets: a mergeable aggregate, combined in the
tasks. Of those left the narrowest counts: int, long, decimal, double; date,
timestamp; boolean; else text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.functions.parse import NUMBER_TEXT, trimmed

INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN = (1 << i for i in range(7))
NUMBERS = INT | LONG | DECIMAL | DOUBLE

INTEGER_TEXT = r"^[+-]?\d+$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"
# Digits of a decimal number.
WIDEST = 38


def _digits(text: Column) -> Column:
    return F.char_length(F.ltrim(F.ltrim(text, F.lit("+-")), F.lit("0")))


def possible_types(text: Column) -> Column:
    """Bits of the types that hold a trimmed text; 0 is text only."""
    whole = (
        F.when(text.try_cast("int").isNotNull(), NUMBERS)
        .when(text.try_cast("bigint").isNotNull(), NUMBERS & ~INT)
        .when(_digits(text) <= WIDEST, DECIMAL | DOUBLE)
        .otherwise(DOUBLE)
    )
    return (
        F.when(text.rlike(INTEGER_TEXT), whole)
        .when(text.rlike(NUMBER_TEXT), DOUBLE)
        .when(text.rlike(DATE_TEXT) & text.try_cast("date").isNotNull(), DATE | TIMESTAMP)
        .when(text.rlike(TIMESTAMP_TEXT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(0)
    )


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, type, filled, empty) of text columns.

    NULL and blank values say nothing, and a column of nothing else is text.
    White space around a value does not count. Decimals have the digits of the
    longest whole number and no places after the point; all others are double.
    """
    names = list(columns or df.columns)
    texts = df.select(*[F.nullif(trimmed(F.col(f"`{c}`")), F.lit("")).alias(f"t{i}") for i, c in enumerate(names)])

    def found(i: int, name: str) -> Column:
        text = F.col(f"t{i}")
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.bit_and(F.when(text.isNotNull(), possible_types(text))).alias("types"),
            F.max(F.when(text.rlike(INTEGER_TEXT), _digits(text))).alias("digits"),
            F.count(text).alias("filled"),
            F.count_if(text.isNull()).alias("empty"),
        )

    rows = texts.agg(F.array(*[found(i, c) for i, c in enumerate(names)]).alias("r")).select(F.inline("r"))

    def has(bit: int) -> Column:
        return F.col("types").bitwiseAND(bit) != 0

    kind = (
        F.when(has(INT), "int")
        .when(has(LONG), "bigint")
        .when(has(DECIMAL), F.concat(F.lit("decimal("), F.col("digits").cast("string"), F.lit(",0)")))
        .when(has(DOUBLE), "double")
        .when(has(DATE), "date")
        .when(has(TIMESTAMP), "timestamp")
        .when(has(BOOLEAN), "boolean")
        .otherwise("string")
    )
    return rows.select("position", "column", kind.alias("type"), "filled", "empty")


def with_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """``df`` with its columns read as the types found; text columns stay as they are."""
    kinds = {r["column"]: r["type"] for r in types.collect()}

    def typed(name: str) -> Column:
        col = F.col(f"`{name}`")
        kind = kinds.get(name, "string")
        return col if kind == "string" else F.nullif(trimmed(col), F.lit("")).try_cast(kind).alias(name)

    return df.select(*[typed(c) for c in df.columns])
