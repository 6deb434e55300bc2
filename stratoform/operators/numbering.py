"""Consecutive surrogate keys without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratoform.session import stage

_ROW_BITS = 33  # documented layout of monotonically_increasing_id


def with_row_numbers(df: DataFrame, order: Sequence[Column | str], output: str) -> DataFrame:
    """``df`` with 1, 2, 3 … in ``order``.

    Equal to ``row_number() over (order by …)`` for a total order. The rows are
    range-sorted once and written; the position within a partition is in the
    generated id, and the partition's offset comes from counts that have one
    row per partition. Writing them first pins each row to its partition, so a
    lost executor cannot renumber some of them.
    """
    placed = stage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), output)
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    # One row per sort partition: small whatever the table's size.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(offsets, "_part")
    return numbered.select(
        (F.col("_offset") + row + 1).alias(output), *[F.col(c) for c in df.columns]
    )
