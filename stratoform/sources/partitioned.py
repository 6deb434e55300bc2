"""Fact tables partitioned by the time of a sale."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class YearlyTable:
    """Parquet table with one directory per year of ``date_column``.

    Only years in ``first_year..last_year`` have a partition; a row outside is
    not stored but returned to the caller.
    """

    path: str
    date_column: str
    first_year: int
    last_year: int

    def _year(self) -> Column:
        return F.year(self.date_column)

    def _accepted(self) -> Column:
        return F.coalesce(self._year().between(self.first_year, self.last_year), F.lit(False))

    def write(self, df: DataFrame) -> None:
        """Store the accepted rows.

        Rows are gathered by year, so that not every task writes into every
        year; the rebalancing splits a large year over several tasks.
        """
        accepted = df.where(self._accepted()).withColumn("sale_year", self._year())
        accepted.hint("rebalance", "sale_year").write.mode("overwrite").partitionBy("sale_year").parquet(self.path)

    def rejected(self, df: DataFrame) -> DataFrame:
        return df.where(~self._accepted())

    def read(
        self, spark: SparkSession, since: dt.date | None = None, until: dt.date | None = None
    ) -> DataFrame:
        """Rows with ``since <= date <= until``; the years implied by that prune directories."""
        df = spark.read.parquet(self.path)
        if since is not None:
            df = df.where((F.col("sale_year") >= since.year) & (F.col(self.date_column) >= F.lit(since)))
        if until is not None:
            df = df.where((F.col("sale_year") <= until.year) & (F.col(self.date_column) <= F.lit(until)))
        return df


@dataclass(frozen=True)
class MonthlyTable:
    """Parquet table with one directory per month of ``date_column``; rows without a date have one of their own.

    Which months are read may be known only while the query runs: joined to a
    table of days, the scan waits for the months of those days and opens no
    other directory (dynamic partition pruning).
    """

    path: str
    date_column: str
    month: str = "sale_month"

    def month_of(self, day: Column | str) -> Column:
        return F.trunc(day, "month")

    def write(self, df: DataFrame, *sorted_by: str) -> None:
        """Store the rows, gathered by month; the rebalancing splits a large month over several tasks."""
        placed = df.withColumn(self.month, self.month_of(self.date_column)).hint("rebalance", self.month)
        placed = placed.sortWithinPartitions(self.month, self.date_column, *sorted_by)
        placed.write.mode("overwrite").partitionBy(self.month).parquet(self.path)

    def read(self, spark: SparkSession, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        df = spark.read.parquet(self.path)
        if since is not None:
            df = df.where((F.col(self.month) >= F.lit(since.replace(day=1))) & (F.col(self.date_column) >= F.lit(since)))
        if until is not None:
            df = df.where((F.col(self.month) <= F.lit(until.replace(day=1))) & (F.col(self.date_column) <= F.lit(until)))
        return df.drop(self.month)

    def read_days(self, days: DataFrame, since: dt.date) -> DataFrame:
        """The rows of the days from ``since`` on that are in ``days``, a table with the date column.

        ``days`` should be stored and small: Spark ships it below its bound for
        broadcasts, and then prunes; beyond that the result is the same, by a plain join.
        """
        rows = days.sparkSession.read.parquet(self.path)
        rows = rows.where((F.col(self.month) >= F.lit(since.replace(day=1))) & (F.col(self.date_column) >= F.lit(since)))
        # The condition on the days is what tells the optimiser that pruning by them pays.
        wanted = days.select(self.date_column).where(F.col(self.date_column) >= F.lit(since)).distinct()
        wanted = wanted.withColumn(self.month, self.month_of(self.date_column))
        return rows.join(wanted, [self.month, self.date_column], "left_semi").drop(self.month)
