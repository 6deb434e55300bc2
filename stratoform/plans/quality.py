"""Data-quality checks.

A check returns the violating rows, or the values to look at; ``scorecard``
turns any number of them into one row each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.functions.dates import is_bad_int_date
from stratoform.operators.versions import spread_nulls


def untrimmed(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != F.trim(column)).select(column)


def domain(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column."""
    return df.select(column).distinct()


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values that are missing or not in ``allowed``."""
    value = F.col(column)
    return domain(df.where(value.isNull() | ~value.isin(*allowed)), column)


def reversed_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(end) < F.col(start))


def reversed_dates(df: DataFrame, first: str, later: Sequence[str]) -> DataFrame:
    """Rows whose first date lies after any of the later ones."""
    return df.where(reduce(lambda a, b: a | b, [F.col(first) > F.col(c) for c in later]))


def bad_int_dates(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    return df.where(is_bad_int_date(value)).select(F.nullif(value, F.lit(0)).alias(column))


def inconsistent_amounts(df: DataFrame, sales: str, quantity: str, price: str) -> DataFrame:
    """Distinct measure triples that break sales = quantity * price, or are missing or not positive."""
    parts = [F.col(sales), F.col(quantity), F.col(price)]
    wrong = parts[0] != parts[1] * parts[2]
    for part in parts:
        wrong = wrong | part.isNull() | (part <= 0)
    return df.where(wrong).select(*parts).distinct().orderBy(*parts)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where("duplicate_count > 1")


def missing_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def orphans(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Facts whose key is in no dimension row; a null key is in none."""
    known = dimension.select(F.col(dimension_key).alias("_known"), F.lit(0).cast("bigint").alias("_known_spread"))
    spread = fact.withColumn("_spread", spread_nulls(fact, key))
    met = (spread[key] == known["_known"]) & (spread["_spread"] == known["_known_spread"])
    return spread.join(known, met, "left_anti").drop("_spread")


def connectivity(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], attributes: Sequence[Column | str]
) -> DataFrame:
    """Fact rows with the attributes of all their dimensions, by shared surrogate key."""
    joined = fact
    for key, dimension in dimensions.items():
        joined = joined.withColumn("_spread", spread_nulls(fact, key))
        joined = joined.join(dimension.withColumn("_spread", F.lit(0).cast("bigint")), [key, "_spread"], "left").drop("_spread")
    return joined.select(*attributes)


def outside_years(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows that no yearly partition accepts."""
    in_range = F.col(column).between(F.lit(dt.date(first, 1, 1)), F.lit(dt.date(last, 12, 31)))
    return df.where(~F.coalesce(in_range, F.lit(False)))


def scorecard(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Rows ``(check_name, violations, passed)``."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations", (F.col("violations") == 0).alias("passed")
        )
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)
