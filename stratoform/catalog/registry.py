"""Registration of queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

Build = Callable[[SparkSession, str], DataFrame]

SINCE = dt.date(1998, 1, 1)
BATCH_TIME = dt.datetime(2025, 1, 1)
REGIONS = ("AMERICA", "ASIA", "EUROPE")


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a builder; its decimals are shown as doubles, as the SQL has them."""

    def register(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(lambda spark, sf_dir: as_doubles(build(spark, sf_dir)), sql)
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def as_doubles(df: DataFrame) -> DataFrame:
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
