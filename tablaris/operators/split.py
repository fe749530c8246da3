"""Repeatable train/test split by a hash of the row key."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablaris.operators.ordering import cut_by_rank

# Hex digits of the hash in use: 32 bits decide a split by threshold, 60 bits
# still fit a long and make ties at an exact cut rare.
THRESHOLD_DIGITS = 8
RANK_DIGITS = 15


def key_hash(keys: Sequence[str], seed: int, digits: int) -> Column:
    """Leading hex digits of md5 over ``key:...:seed``; text order is number order."""
    # A NULL must count: ('a', NULL) and (NULL, 'a') are different keys.
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.substring(F.md5(F.concat_ws(":", *parts, F.lit(str(seed))).cast("binary")), 1, digits)


def train_test_split(
    df: DataFrame,
    keys: Sequence[str],
    test_share: float = 0.2,
    seed: int = 42,
    exact: bool = False,
    out: str = "is_test",
) -> DataFrame:
    """Mark test rows with 1.

    By default a row is decided by its own hash: no pass over the data, and
    new rows never move old ones. ``exact`` takes precisely the
    ``ceil(test_share * n)`` smallest hashes, at the cost of finding the cut.
    """
    if not exact:
        limit = int(test_share * 16**THRESHOLD_DIGITS)
        if limit >= 16**THRESHOLD_DIGITS:
            return df.withColumn(out, F.lit(1))
        chosen = key_hash(keys, seed, THRESHOLD_DIGITS) < f"{limit:0{THRESHOLD_DIGITS}x}"
        return df.withColumn(out, chosen.cast("int"))

    share = Fraction(test_share).limit_denominator(10**9)
    number = F.conv(key_hash(keys, seed, RANK_DIGITS), 16, 10).cast("long")
    hashed = df.withColumn("_hash", number)
    cut = cut_by_rank(hashed, ["_hash", *keys], lambda n: [math.ceil(share * n)], out)
    return cut.withColumn(out, 1 - F.col(out)).drop("_hash")
