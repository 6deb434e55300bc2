"""Versioned rows: end of validity and lookup of the version in force.

Both work at day grain and never gather the rows of a key: they reduce each
``(key, day)`` first, walk the days of a key in a window whose size is bounded
by the calendar, and bring the answer back with an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    tests = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def spread_nulls(df: DataFrame, key: str) -> Column:
    """A second join key that deals out rows without ``key``, which match nothing; 0 for all others.

    Without it they would all hash to one task of an outer or anti join.
    """
    return F.when(F.col(key).isNull(), F.xxhash64(*df.columns)).otherwise(0)


def _next_instants(instants: DataFrame, is_date: bool) -> DataFrame:
    """(_key, _first) with ``_next``, the next larger start of the key; null comes before all others.

    The windows go over the days of a key, the seconds of a day and the
    instants of a second, so the calendar bounds each of them.
    """
    over = lambda *keys: F.lead("_first").over(Window.partitionBy(*keys).orderBy("_first"))
    if is_date:
        return instants.withColumn("_next", over("_key"))
    at = F.col("_first")
    if isinstance(instants.schema["_first"].dataType, T.TimestampType):
        second = F.unix_seconds(at)
    else:
        clock = (F.hour(at) * 60 + F.minute(at)) * 60 + F.floor(F.second(at))
        second = F.unix_date(F.to_date(at)).cast("bigint") * 86400 + clock
    moments = instants.withColumn("_second", second).withColumn("_day", F.floor(F.col("_second") / 86400))
    seconds = moments.groupBy("_key", "_day", "_second").agg(F.min("_first").alias("_first"))
    days = seconds.groupBy("_key", "_day").agg(F.min("_first").alias("_first"))
    by_second = seconds.select(F.col("_key").alias("_key2"), F.col("_second").alias("_second2"), over("_key", "_day").alias("_in_day"))
    by_day = days.select(F.col("_key").alias("_key3"), F.col("_day").alias("_day3"), over("_key").alias("_later"))
    moments = moments.withColumn("_in_second", over("_key", "_second"))
    met = moments.join(by_second, _same(moments, by_second, [("_key", "_key2"), ("_second", "_second2")]))
    met = met.join(by_day, _same(met, by_day, [("_key", "_key3"), ("_day", "_day3")]))
    return met.select("_key", "_first", "_last", F.coalesce("_in_second", "_in_day", "_later").alias("_next"))


def with_next_start(
    df: DataFrame, key: str, start: str, tiebreak: Sequence[str], output: str = "next_start"
) -> DataFrame:
    """Start of the following version of the same key, null for the last one.

    Equal to ``lead(start) over (partition by key order by start, tiebreak)`` for
    a tiebreak that tells the rows of a key and start apart; rows alike in it
    get the same next start. Of the rows that share key and start, the last one
    is followed by the next larger start and all others by their own, so one
    maximum for each start, formed in the map tasks, is all the order it takes.
    """
    instants = df.groupBy(F.col(key).alias("_key"), F.col(start).alias("_first")).agg(
        F.max(F.struct(*tiebreak)).alias("_last")
    )
    following = _next_instants(instants, isinstance(df.schema[start].dataType, T.DateType))
    met = df.join(following, _same(df, following, [(key, "_key"), (start, "_first")]))
    is_last = F.struct(*[df[c] for c in tiebreak]).eqNullSafe(F.col("_last"))
    return met.select(*[df[c] for c in df.columns], F.when(is_last, F.col("_next")).otherwise(df[start]).alias(output))


def with_version_in_force(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    on: str,
    start: str,
    tiebreak: Sequence[str],
    attributes: Sequence[str],
    end: str | None = None,
) -> DataFrame:
    """Each fact with ``attributes`` of the version valid on its day.

    A version is valid from the day it starts to the day before the next one
    starts, or to its stored last day if ``end`` names one that is earlier; of
    several that start on one day the last counts. Facts before the
    first version, or without a key or day, get nulls. ``key`` is the column
    name on both sides.

    Versions are reduced to one per key and day with the day of the next, so
    a fact matches one at most; the facts are read once and joined by key.
    """
    newest = F.struct(F.col(start), *[F.col(c) for c in tiebreak])
    started = (
        versions.where(F.col(start).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.to_date(start).alias("_from"))
        .agg(
            F.max_by(F.struct(*attributes), newest).alias("_version"),
            F.max_by(F.struct(F.col(end or start).alias("last")), newest).alias("_end"),
        )
    )
    calendar = Window.partitionBy("_key").orderBy("_from")
    until = F.lead("_from").over(calendar)
    if end:
        # Stored ends may overlap or be open; the next start ends a version in any case.
        until = F.least(F.date_add(F.to_date("_end.last"), 1), until)
    valid = started.withColumn("_until", until).withColumn("_spread_key", F.lit(0).cast("bigint"))
    rows = facts.withColumn("_spread", spread_nulls(facts, key)).withColumn("_day", F.to_date(on))
    hit = (
        (rows[key] == valid["_key"])
        & (rows["_spread"] == valid["_spread_key"])
        & (rows["_day"] >= valid["_from"])
        & (valid["_until"].isNull() | (rows["_day"] < valid["_until"]))
    )
    return rows.join(valid, hit, "left").select(
        *[rows[c] for c in facts.columns], *[F.col(f"_version.{a}").alias(a) for a in attributes]
    )
