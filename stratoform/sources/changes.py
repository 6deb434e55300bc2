"""Change extraction, and a Parquet table that takes changes."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratoform.functions.dates import instant
from stratoform.operators.latest import latest_per_key, upsert_latest
from stratoform.session import SMALL, remove
from stratoform.sources.commits import CommitLog, Entry, State

WINDOW = dt.timedelta(days=1)
#: Changes are few if the rows that they may touch are this many times as many.
FEW = 8
_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def newest(df: DataFrame, change_time: str) -> dt.datetime | None:
    """Largest change time, one value; the watermark of the next extraction."""
    return df.agg(F.max(change_time).alias("newest")).first()["newest"]


def changed_since(source: DataFrame, change_time: str, watermark: dt.datetime) -> DataFrame:
    """Rows changed after ``watermark``. As a literal it is filtered in the source."""
    return source.where(F.col(change_time) > instant(watermark, source.schema[change_time].dataType))


def changed_or_undated(source: DataFrame, change_time: str, since: dt.datetime) -> DataFrame:
    """Rows changed at ``since`` or later, and all whose change is not dated."""
    at = F.col(change_time)
    return source.where((at >= instant(since, source.schema[change_time].dataType)) | at.isNull())


def _same(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, (left[k].eqNullSafe(right[k]) for k in keys))


def _wins(change: str, row: str, newest_by: tuple[str, ...], others: list[str]) -> Column:
    """Whether the change goes before the row it meets: the order of ``latest_per_key``."""
    wins = F.lit(False)
    for name in reversed([*newest_by, *others]):
        own, old = F.col(f"{change}.{name}"), F.col(f"{row}.{name}")
        first = own > old if name in newest_by else own < old
        better = own.isNotNull() & (old.isNull() | F.coalesce(first, F.lit(False)))
        wins = F.when(better, True).when(own.eqNullSafe(old), wins).otherwise(False)
    return wins


@dataclass(frozen=True)
class KeyedTable:
    """Parquet table that holds the newest row of each key.

    A full load writes a folder of its own; changes are written as they come,
    one small folder each, and merged when the table is read, so a change costs
    what it holds and not what the table holds. After ``max_deltas`` of them
    the merged rows become the new base. A commit names a folder when it is
    complete, so readers never see a half-written load, and a failed one leaves
    the table as it was. Loads that run at the same time are committed one
    after the other; both count.

    The last ``kept`` versions, by default ``max_deltas`` of them, can be read, and
    the rows that changed between two of them can be had with signs.

    Without keys the table is append-only by time: changes replace all rows
    from a point in time on (``newest_by[0]``), undated ones included.
    """

    path: str
    keys: tuple[str, ...]
    newest_by: tuple[str, ...]
    max_deltas: int = 8
    kept: int | None = None

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path, self.max_deltas if self.kept is None else self.kept)

    def version(self, spark: SparkSession) -> int:
        """The number of the newest commit; -1 if there is none."""
        return self.log.state(spark).version

    def _put(self, df: DataFrame, kind: str, since: dt.datetime | None = None) -> State:
        folder = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}", compression=SMALL)

        def entry(state: State) -> Entry:
            upto = state.version if kind == "base" else None
            return Entry(0, kind, folder, upto, since and since.isoformat())

        return self.log.commit(df.sparkSession, entry)

    def exists(self, spark: SparkSession) -> bool:
        """Whether a load has put at least one row there."""
        state = self.log.state(spark)
        return state.version >= 0 and not self._rows(spark, state).isEmpty()

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows now, or as they were after commit ``version``."""
        state = self.log.state(spark, version)
        if state.version < 0:
            raise ValueError(f"no table at {self.path}")
        return self._rows(spark, state)

    def _rows(self, spark: SparkSession, state: State) -> DataFrame:
        rows = spark.read.parquet(f"{self.path}/{state.base.folder}") if state.base else None
        waiting: list[DataFrame] = []
        for change in state.changes:
            part = spark.read.parquet(f"{self.path}/{change.folder}")
            if not self.keys:
                rows = part if rows is None else self._from(rows, dt.datetime.fromisoformat(change.since)).unionByName(part)
            elif change.kind == "delete":
                rows, waiting = self._merged(rows, waiting), []
                if rows is not None:
                    rows = rows.join(part, _same(rows, part, self.keys), "left_anti")
            else:
                waiting.append(part)
        return self._merged(rows, waiting)

    def _from(self, rows: DataFrame, since: dt.datetime) -> DataFrame:
        return rows.where(F.col(self.newest_by[0]) < instant(since, rows.schema[self.newest_by[0]].dataType))

    def _merged(self, rows: DataFrame | None, parts: list[DataFrame]) -> DataFrame | None:
        """The rows after the changes: each meets the change of its key, and changes that meet none are added."""
        if not parts:
            return rows
        changes = latest_per_key(reduce(DataFrame.unionByName, parts), self.keys, self.newest_by)
        if rows is None:
            return changes
        columns = rows.columns
        others = [c for c in columns if c not in {*self.keys, *self.newest_by}]
        old = rows.select(F.struct(*columns).alias("_old"), *self.keys)
        new = changes.select(F.struct(*columns).alias("_new"), *self.keys)
        met = old.join(new, _same(old, new, self.keys), "left")
        newer = F.col("_new").isNotNull() & _wins("_new", "_old", self.newest_by, others)
        current = met.select(F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")
        known = rows.select(*self.keys)
        return current.unionByName(changes.join(known, _same(changes, known, self.keys), "left_anti"))

    def publish(self, spark: SparkSession, name: str) -> None:
        """Catalog view of that name over the rows, after merging what is not merged."""
        state = self.log.state(spark)
        while state.changes or state.base is None:
            self.compact(spark)
            state = self.log.state(spark)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{self.path}/{state.base.folder}`")

    def compact(self, spark: SparkSession) -> None:
        """Writes the merged rows as the base; changes that are committed meanwhile stay in force after it."""
        state = self.log.state(spark)
        folder = f"merged-{uuid.uuid4().hex}"
        self._rows(spark, state).write.parquet(f"{self.path}/{folder}", compression=SMALL)
        # A base that another writer put there meanwhile is newer than what was read here.
        after = self.log.commit(
            spark, lambda now: Entry(0, "merged", folder, state.version) if now.base == state.base else None
        )
        if folder not in after.folders():
            remove(spark, f"{self.path}/{folder}")

    def replace(self, df: DataFrame) -> None:
        """Full load: these rows and no others."""
        self._put(latest_per_key(df, self.keys, self.newest_by) if self.keys else df, "base")

    def upsert(self, changes: DataFrame, since: dt.datetime | None = None) -> None:
        """Merge ``changes``; running it again changes nothing.

        Without keys ``changes`` are all rows from ``since`` on and all undated ones.
        """
        if self.keys:
            state = self._put(latest_per_key(changes, self.keys, self.newest_by), "delta")
        elif since is None:
            raise ValueError("a table without keys needs the time from which its rows are replaced")
        else:
            state = self._put(changes, "delta", since)
        if len(state.changes) > self.max_deltas:
            self.compact(changes.sparkSession)

    def delete(self, gone: DataFrame) -> None:
        """Removes the rows of the keys in ``gone``; a later load of a key puts it back."""
        if not self.keys:
            raise ValueError("a table without keys has no rows to name")
        state = self._put(gone.select(*self.keys).distinct(), "delete")
        if len(state.changes) > self.max_deltas:
            self.compact(gone.sparkSession)

    def changes_between(self, spark: SparkSession, before: int, after: int, sign: str = "weight") -> DataFrame:
        """The rows that went (``sign`` -1) and came (1) from one version to another.

        A corrected row is there twice, an unchanged one
        not at all, and the signed rows added to the old ones give the new ones.
        """
        if all(e.kind == "merged" for e in self.log.entries(spark, before, after)):
            return self.read(spark, after).limit(0).withColumn(sign, F.lit(1))
        if self.keys:
            current = self._current(spark, [self.log.state(spark, v) for v in (before, after)])
            both = current.withColumn(sign, F.col("_in1").cast("int") - F.col("_in0").cast("int")).drop("_in0", "_in1")
            both = both.where(F.col(sign) != 0)
        else:
            sides = [self.read(spark, v).withColumn(sign, F.lit(w)) for v, w in ((before, -1), (after, 1))]
            both = sides[0].unionByName(sides[1])
        columns = [c for c in both.columns if c != sign]
        return both.groupBy(*columns).agg(F.sum(sign).cast("int").alias(sign)).where(F.col(sign) != 0)

    def _current(self, spark: SparkSession, states: list[State]) -> DataFrame:
        """The rows of all folders, each folder read once, with ``_in{i}``: whether it is its key's row in state i.

        As ``_rows`` has it: a deletion ends the rows before it, and of the others
        the first in the order of ``latest_per_key`` counts. A key has a row in
        each folder at most, so its rows meet in one shuffle and one sort. Where
        little was changed, only the changed keys' rows take part.
        """
        entries = {e.folder: e for s in states for e in ((s.base, *s.changes) if s.base else s.changes)}
        # How many deletions there are up to a folder, its own included.
        places: dict[str, list[int | None]] = {folder: [None] * len(states) for folder in entries}
        for i, state in enumerate(states):
            deletions = 0
            for e in (state.base, *state.changes) if state.base else state.changes:
                deletions += e.kind == "delete"
                places[e.folder][i] = deletions
        parts = {folder: spark.read.parquet(f"{self.path}/{folder}") for folder in entries}
        columns = next((parts[f].columns for f, e in entries.items() if e.kind != "delete"), list(self.keys))
        parts = self._of_changed(parts, places, entries)
        placed = []
        for folder, part in parts.items():
            deletes = entries[folder].kind == "delete"
            empty = {c: F.lit(None) for c in columns if c not in self.keys} if deletes else {}
            at = {f"_at{i}": F.lit(p).cast("int") for i, p in enumerate(places[folder])}
            placed.append(part.withColumns(empty | at | {"_gone": F.lit(deletes)}))
        rows = reduce(DataFrame.unionByName, placed)
        others = [c for c in columns if c not in {*self.keys, *self.newest_by}]
        order = [*[F.col(c).desc_nulls_last() for c in self.newest_by], *[F.col(c).asc_nulls_last() for c in others]]
        key = Window.partitionBy(*self.keys).orderBy(*order)
        whole, upto = key.rowsBetween(_FIRST, _LAST), key.rowsBetween(_FIRST, Window.currentRow)
        sides = range(len(states))
        gone = {f"_gone{i}": F.max(F.when(F.col("_gone"), F.col(f"_at{i}"))).over(whole) for i in sides}
        rows = rows.withColumns(gone).where(~F.col("_gone"))
        rows = rows.withColumns({f"_has{i}": F.coalesce(F.col(f"_at{i}") >= F.coalesce(f"_gone{i}", F.lit(0)), F.lit(False)) for i in sides})
        rows = rows.withColumns({f"_n{i}": F.count_if(F.col(f"_has{i}")).over(upto) for i in sides})
        return rows.select(*columns, *[(F.col(f"_has{i}") & (F.col(f"_n{i}") == 1)).alias(f"_in{i}") for i in sides])

    def _of_changed(
        self, parts: dict[str, DataFrame], places: dict[str, list[int | None]], entries: dict[str, Entry]
    ) -> dict[str, DataFrame]:
        """``parts`` without keys that are in folders of all states only, if the other folders are small; their rows are counted from footers."""
        common = {f for f, p in places.items() if None not in p and entries[f].kind != "delete"}
        some = [parts[f] for f in parts if f not in common]
        if not common or not some or FEW * sum(p.count() for p in some) > sum(parts[f].count() for f in common):
            return parts
        touched = reduce(DataFrame.unionByName, (p.select(*self.keys) for p in some)).distinct()
        return {f: p.join(touched, _same(p, touched, self.keys), "left_semi") if f in common else p for f, p in parts.items()}
