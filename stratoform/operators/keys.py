"""Surrogate keys that last: a registry of members and the numbers given to them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.operators.numbering import with_row_numbers
from stratoform.session import remove
from stratoform.sources.commits import CommitLog, Entry, State

MOST_FOLDERS = 16


@dataclass(frozen=True)
class KeyRegistry:
    """A stored table of members, named by their ``natural`` columns, and the key of each.

    A member keeps its key for ever, so facts that were loaded before go on
    pointing to it. New members are those that the registry does not have; they
    are numbered behind the largest key given out, in an order of the caller.
    An assignment is one commit. If another one came first, the members are
    compared with the newer registry and numbered again, so no key is given
    twice and no member has two. A repeated assignment adds nothing.

    An assignment reads the members and the natural columns of the registry,
    and writes the new members only. The folders are put together when those
    after the merged one hold half as many keys as it, or are ``MOST_FOLDERS``.
    """

    path: str
    natural: tuple[str, ...]
    key: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """(natural columns, key) of all members; None before the first assignment."""
        return self._rows(spark, self.log.state(spark, version))

    def _rows(self, spark: SparkSession, state: State) -> DataFrame | None:
        folders = [e.folder for e in ((state.base,) if state.base else ()) + state.changes]
        if not folders:
            return None
        return reduce(DataFrame.unionByName, (spark.read.parquet(f"{self.path}/{f}") for f in folders))

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in self.natural))

    def _new(self, members: DataFrame, state: State) -> DataFrame:
        known = self._rows(members.sparkSession, state)
        return members if known is None else members.join(known, self._same(members, known), "left_anti")

    def assign(self, members: DataFrame, order: Sequence[Column | str] = ()) -> int:
        """Gives a key to each member that has none, in ``order``, then in that of the natural columns.

        ``members`` may have a member several times; the first row in the order
        counts. Returns how many were new.
        """
        spark = members.sparkSession
        by = [*order, *self.natural]
        names = [f"_by{i}" for i in range(len(by))]
        ranked = members.select(*self.natural, *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(by, names, strict=True)])
        one = ranked.groupBy(*self.natural).agg(F.min(F.struct(*names)).alias("_first"))
        written: list[tuple[str, int]] = []

        def entry(state: State) -> Entry | None:
            while written:  # numbered behind a state that is out of date
                remove(spark, f"{self.path}/{written.pop()[0]}")
            last = _last(state)
            numbered = with_row_numbers(self._new(one, state), ["_first"], "_number")
            folder = f"keys-{uuid.uuid4().hex}"
            numbered.select(*self.natural, (F.col("_number") + last).alias(self.key)).write.parquet(f"{self.path}/{folder}")
            added = spark.read.parquet(f"{self.path}/{folder}").count()
            written.append((folder, added))
            return Entry(0, "delta", folder, until=last + added) if added else None

        state = self.log.commit(spark, entry)
        folder, added = written[-1]
        if not added:
            remove(spark, f"{self.path}/{folder}")
            return 0
        self._merge(spark, state)
        return added

    def _merge(self, spark: SparkSession, state: State) -> None:
        """Puts all folders together once those after the base hold half of its keys, or there are many."""
        held = state.base.until if state.base else 0
        last = _last(state)
        if len(state.changes) < 2 or (2 * (last - held) < held and len(state.changes) < MOST_FOLDERS):
            return
        folder = f"merged-{uuid.uuid4().hex}"
        self._rows(spark, state).write.parquet(f"{self.path}/{folder}")
        after = self.log.commit(
            spark, lambda now: Entry(0, "merged", folder, state.version, until=last) if now.base == state.base else None
        )
        if folder not in after.folders():
            remove(spark, f"{self.path}/{folder}")

    def keyed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the key of their member in front; null for one that has none."""
        known = self.read(rows.sparkSession)
        if known is None:
            return rows.select(F.lit(None).cast("bigint").alias(self.key), *rows.columns)
        met = rows.join(known, self._same(rows, known), "left")
        return met.select(known[self.key], *[rows[c] for c in rows.columns])


def _last(state: State) -> int:
    """The largest key given out; 0 if none."""
    return max((e.until or 0 for e in ((state.base,) if state.base else ()) + state.changes), default=0)
