"""Hash positions of the Bloom filter and the Count-Min sketch.

Two independent hashes give all positions, ``h1 + i * h2 (mod size)``, so one
item is hashed once whatever the number of functions or rows.
"""

from __future__ import annotations

from enum import StrEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SECOND_SEED = 104729


class Hash(StrEnum):
    """``FAST`` is for use; ``PORTABLE`` can be recomputed by any SQL engine."""

    FAST = "xxhash64"
    PORTABLE = "md5"


def _unsigned_hex(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def hash_pair(item: Column, kind: Hash = Hash.FAST) -> tuple[Column, Column]:
    """A 60-bit and a 28-bit non-negative hash, null for null; their combinations fit a bigint."""
    text = item.cast("string")
    if kind == Hash.PORTABLE:
        digest = F.md5(text)
        return _unsigned_hex(F.substring(digest, 1, 15)), _unsigned_hex(F.substring(digest, 16, 7)) + 1
    # xxhash64 skips nulls and would give them its seed.
    known = text.isNotNull()
    first = F.when(known, F.xxhash64(text).bitwiseAND(F.lit((1 << 60) - 1)))
    second = F.when(known, F.xxhash64(text, F.lit(_SECOND_SEED)).bitwiseAND(F.lit((1 << 28) - 1)) + 1)
    return first, second


def positions(item: Column, count: int, size: int, kind: Hash = Hash.FAST) -> list[Column]:
    """The item's position under each function."""
    return _positions(*hash_pair(item, kind), count, size)


def with_positions(
    df: DataFrame, column: str, count: int, size: int, kind: Hash = Hash.FAST
) -> tuple[DataFrame, list[Column]]:
    """``df`` with the two hashes of a column, and the positions on top of them.

    An operator that uses the positions one by one, such as ``explode``, then
    hashes each row once; Spark does not merge projections that would repeat
    the hashing.
    """
    h1, h2 = hash_pair(F.col(column), kind)
    hashed = df.withColumns({"_h1": h1, "_h2": h2})
    return hashed, _positions(F.col("_h1"), F.col("_h2"), count, size)


def _positions(h1: Column, h2: Column, count: int, size: int) -> list[Column]:
    return [F.pmod(h1 + h2 * i, F.lit(size).cast("bigint")) for i in range(count)]


def bucket(item: Column, buckets: int, kind: Hash = Hash.FAST) -> Column:
    return F.pmod(hash_pair(item, kind)[0], F.lit(buckets).cast("bigint"))
