"""Text to number, where anything unreadable becomes NULL.

Spark's ANSI mode (on by default) makes ``cast`` raise on bad text, so all of
these go through ``try_cast``; they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation: optional sign, digits, at most one dot.
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)$"


# As above, with an exponent, or one of the words for what is not a finite number.
NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


# FIXED VALUES: the characters that Unicode calls white space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def trimmed(text: Column) -> Column:
    """Without white space of any kind at the ends; linear, unlike a pattern tied to the end.

    Spaces go first. The rest is looked for only where an end is not a visible ASCII character.
    """
    bare = F.trim(text)
    return F.when(_visible(F.substring(bare, 1, 1)) & _visible(F.substring(bare, -1, 1)), bare).otherwise(F.btrim(bare, F.lit(WHITE_SPACE)))


def _visible(letter: Column) -> Column:
    return letter.between("!", "~")


def clean_text(col: Column, decimal_comma: bool) -> Column:
    """Trimmed text, with every comma read as a decimal point on request."""
    text = F.trim(col.cast("string"))
    return F.replace(text, F.lit(","), F.lit(".")) if decimal_comma else text


def parse_double(col: Column, decimal_comma: bool = True) -> Column:
    return clean_text(col, decimal_comma).try_cast("double")


def parse_int(col: Column, decimal_comma: bool = True) -> Column:
    """Whole part of a plain decimal text; exponents, suffixes and overflow give NULL.

    ``try_cast('12.5' as int)`` alone is NULL, hence the step through double.
    """
    text = clean_text(col, decimal_comma)
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double").try_cast("int"))


def parse_number(col: Column) -> Column:
    """Coerce a column of any type to double, failures to NULL.

    A text is a number as a whole or not at all: ``1d`` and ``2f`` are not.
    """
    return parse_trimmed(trimmed(col.cast("string")))


def parse_trimmed(text: Column) -> Column:
    """:func:`parse_number` of a text without white space at its ends."""
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def is_finite(col: Column) -> Column:
    """False for NaN and the infinities, true for all else, NULL included."""
    return ~(F.isnan(col) | F.abs(col).eqNullSafe(F.lit(float("inf"))))
