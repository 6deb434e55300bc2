"""Distinct-count sketches on Spark's built-in HyperLogLog aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 12
# Three standard errors at 2^12 registers: 3 * 1.04 / sqrt(4096).
TOLERANCE = 0.049


def sketches(
    df: DataFrame, item: Column, by: Sequence[Column | str] = (), log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """One mergeable sketch per group, in column ``sketch``; nulls are skipped."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(item, log_registers).alias("sketch"))


def union(parts: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Sketch of the items of all ``parts`` of a group."""
    return parts.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: Column | str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def error_rate(estimated: Column, actual: Column) -> Column:
    """Relative error; an empty set counts as one so the ratio is defined."""
    return F.abs(estimated - actual) / F.greatest(actual, F.lit(1).cast("bigint"))


def column_report(df: DataFrame, columns: Sequence[str], log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Estimate and exact distinct count of each column, in one pass over ``df``.

    The columns become ``(column, value)`` pairs that are counted and sketched
    per distinct pair, so several exact distincts cost one shuffle.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("pair")
    ).select("pair.*")
    distinct = pairs.where(F.col("value").isNotNull()).distinct()
    return (
        distinct.groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("actual"),
            F.hll_sketch_estimate(F.hll_sketch_agg("value", log_registers)).alias("estimate"),
        )
        .withColumn("error_rate", error_rate(F.col("estimate"), F.col("actual")))
    )
