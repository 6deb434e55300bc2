"""Physical layouts that serve the reads an index would."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_sorted(df: DataFrame, path: str, *columns: str) -> None:
    """Copy sorted by ``columns`` across files, so min/max statistics skip most of them.

    A hash of the whole row is the last range key: without it all rows of one
    hot value would be sorted and written by a single task.
    """
    spread = F.xxhash64(*df.columns)
    df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def _ordered(df: DataFrame, column: str) -> Column:
    """A value that has quantiles, in the order of the column: of a text the number that its first seven bytes make."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    start = F.hex(F.substring(F.col(column).cast("binary"), 1, 7))
    return F.conv(F.rpad(start, 14, "0"), 16, 10).cast("bigint")


def _rank(value: Column, bounds: Sequence) -> Column:
    """How many of the sorted bounds are not above the value, by halving; 0 for null."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    known = F.array(*[F.lit(b) for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (value >= F.get(known, at + step - 1)), at + step
        ).otherwise(at),
    )


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = 6, accuracy: int = 4096) -> Column:
    """The place of a row on a curve through all combinations of the columns' ranks.

    A column's values are ranked into ``2 ** bits`` parts of about equal size,
    whose bounds come from one pass over the rows; the bits of the ranks are
    interleaved, so rows that are close on the curve are close in every column.
    """
    parts = [i / (1 << bits) for i in range(1, 1 << bits)]
    values = [_ordered(df, c) for c in columns]
    found = df.agg(*[F.percentile_approx(v, parts, accuracy).alias(f"_{i}") for i, v in enumerate(values)]).first()
    ranks = [_rank(v, found[f"_{i}"]) if found[f"_{i}"] else F.lit(0) for i, v in enumerate(values)]
    placed = []
    for k, rank in enumerate(ranks):
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("bigint")
            placed.append(F.shiftleft(bit, i * len(columns) + len(columns) - 1 - k))
    return reduce(Column.bitwiseOR, placed)


def write_on_curve(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6) -> None:
    """Copy in ``files`` files along the curve, so that a range of any of the columns is in few of them.

    Equal places are split by a hash of the whole row, as in ``write_sorted``.
    """
    placed = df.withColumn("_place", curve_place(df, columns, bits))
    spread = F.xxhash64(*df.columns)
    ranged = placed.repartitionByRange(files, "_place", spread).sortWithinPartitions("_place")
    ranged.drop("_place").write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class RangeCopy:
    """Sorted copy of the rows with ``column >= lower``: a partial index."""

    path: str
    column: str
    lower: object

    @classmethod
    def write(cls, df: DataFrame, path: str, column: str, lower: object) -> RangeCopy:
        write_sorted(df.where(F.col(column) >= F.lit(lower)), path, column)
        return cls(path, column, lower)

    def serves(self, lower: object) -> bool:
        """Whether ``column >= lower`` implies the copy's own condition."""
        return lower is not None and lower >= self.lower

    def read(self, base: DataFrame, lower: object, extra: Column | None = None) -> DataFrame:
        """Rows from ``lower`` on: from the copy if it has them all, else from ``base``."""
        spark: SparkSession = base.sparkSession
        source = spark.read.schema(base.schema).parquet(self.path) if self.serves(lower) else base
        rows = source.where(F.col(self.column) >= F.lit(lower)) if lower is not None else source
        return rows if extra is None else rows.where(extra)
