"""Column-level helpers: name normalization and tolerant parsing."""

from tablaris.functions.names import normalize_name
from tablaris.functions.parse import parse_double, parse_int, parse_number

__all__ = ["normalize_name", "parse_double", "parse_int", "parse_number"]
