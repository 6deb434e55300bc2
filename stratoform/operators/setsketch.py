"""Theta sketches: distinct counts of unions, intersections and differences.

A sketch keeps the smallest hashes of a set, 2 ** LOG_ENTRIES of them, and so
counts smaller sets exactly. One sketch is stored for each part of the data, a
day and a class say; a subset is the union of its parts, and subsets are
combined without the data. The error of a combination is relative to the union
of all that goes into it, however small the result is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES = 12


def tolerance(log_entries: int = LOG_ENTRIES) -> float:
    """Three standard errors, as a share of the union."""
    return 3 / ((1 << log_entries) - 1) ** 0.5


def set_sketches(df: DataFrame, item: Column, by: Sequence[Column | str], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One sketch of the items of each group, in column ``sketch``; nulls are skipped."""
    return df.where(item.isNotNull()).groupBy(*by).agg(F.theta_sketch_agg(item, log_entries).alias("sketch"))


@dataclass(frozen=True)
class SetOf:
    """A subset by name, or a combination of two: ``&`` both, ``|`` either, ``-`` the first without the second."""

    name: str = ""
    op: str = ""
    left: SetOf | None = None
    right: SetOf | None = None

    def __and__(self, other: SetOf) -> SetOf:
        return SetOf(op="theta_intersection", left=self, right=other)

    def __or__(self, other: SetOf) -> SetOf:
        return SetOf(op="theta_union", left=self, right=other)

    def __sub__(self, other: SetOf) -> SetOf:
        return SetOf(op="theta_difference", left=self, right=other)

    def names(self) -> set[str]:
        return {self.name} if self.name else self.left.names() | self.right.names()

    def sketch(self) -> Column:
        return F.col(f"`{self.name}`") if self.name else getattr(F, self.op)(self.left.sketch(), self.right.sketch())

    def bound(self) -> Column:
        """How far the estimate may be off: a share of the union of all subsets named."""
        names = sorted(self.names())
        union = F.col(f"`{names[0]}`")
        for name in names[1:]:
            union = F.theta_union(union, F.col(f"`{name}`"))
        return F.theta_sketch_estimate(union)


def combined(
    parts: DataFrame, subsets: Mapping[str, Column], wanted: Mapping[str, SetOf], log_entries: int = LOG_ENTRIES
) -> DataFrame:
    """(subset, estimate, most_off) of each wanted combination, from stored sketches alone.

    ``subsets`` are conditions on the parts. They are united in one pass.
    """
    names = sorted(set().union(*(w.names() for w in wanted.values())))
    # A sketch of nothing stands for a subset without any part.
    none = F.theta_sketch_agg(F.lit(None).cast("bigint"), log_entries)
    united = parts.agg(*[F.coalesce(F.theta_union_agg(F.when(subsets[n], F.col("sketch")), log_entries), none).alias(n) for n in names])
    rows = [
        F.struct(
            F.lit(name).alias("subset"),
            F.theta_sketch_estimate(of.sketch()).alias("estimate"),
            F.ceil(of.bound() * tolerance(log_entries)).cast("bigint").alias("most_off"),
        )
        for name, of in wanted.items()
    ]
    return united.select(F.inline(F.array(*rows)))
