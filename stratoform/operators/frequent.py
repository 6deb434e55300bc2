"""Frequent items from mergeable sketches, with bounds of their counts.

A sketch tracks a bounded number of items; those that occur seldom make room
and add to its error. Sketches of parts unite to one of the whole, so heavy
hitters of a range of days, say, come from a stored sketch for each day. Unlike
Count-Min a sketch lists its items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 8_192


def error_share(tracked: int = TRACKED) -> float:
    """How far a count may be off, as a share of all occurrences: 3.5 over the places of the sketch's table."""
    return 3.5 / (1 << (tracked * 4 // 3 - 1).bit_length())


def frequent_sketches(df: DataFrame, item: Column, by: Sequence[Column | str] = (), tracked: int = TRACKED) -> DataFrame:
    """(by, n, sketch): occurrences and sketch of the items of each group; nulls are skipped."""
    known = df.withColumn("_item", item).where("_item is not null")
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(_item, {tracked})").alias("sketch")
    )


def united(parts: DataFrame, by: Sequence[Column | str] = (), tracked: int = TRACKED) -> DataFrame:
    """(by, n, sketch) of the items of all parts of a group."""
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))


def heavy_hitters(whole: DataFrame, share: float, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """(by, item, at_least, at_most): every item with ``share`` of the occurrences or more, and bounds of its count.

    An item below the share is listed only if its bounds reach it. A share
    that the sketch cannot promise to list is refused.
    """
    if share < 2 * error_share(tracked):
        raise ValueError(f"{tracked} tracked items list shares from {2 * error_share(tracked):.2g} on")
    found = whole.select(*by, "n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("_e"))
    off = F.floor(F.col("n") * error_share(tracked)).cast("bigint")
    most = F.col("_e.count")
    return found.where(most >= F.col("n") * share).select(
        *by, F.col("_e.item").alias("item"), F.greatest(most - off, F.lit(1)).alias("at_least"), most.alias("at_most")
    )
