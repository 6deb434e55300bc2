"""Load of many tables with one outcome per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratoform.session import stage
from stratoform.sources.changes import WINDOW, KeyedTable, changed_or_undated, newest
from stratoform.sources.files import Source
from stratoform.sources.jobs import JobConfig, JobRun, JobStore, config_records, log_records

Clock = Callable[[], dt.datetime]
OUTCOME = (
    "table_name string, load_mode string, status string, records bigint, "
    "seconds int, error_message string"
)


@dataclass(frozen=True)
class TableLoad:
    """One mapping: a source, its target and the column that dates changes."""

    name: str
    source: Source
    target: KeyedTable
    change_time: str | None = None
    source_schema: str = "public"
    layer: str = "bronze"

    @property
    def job_name(self) -> str:
        return f"extract_{self.name}_to_{self.layer}.{self.name}"


def load_mode(spark: SparkSession, load: TableLoad) -> str:
    """An empty target, or one without any change time to go by, is loaded in full."""
    if load.change_time is None or not load.target.exists(spark):
        return "full"
    return "full" if newest(load.target.read(spark), load.change_time) is None else "increment"


def _since(spark: SparkSession, load: TableLoad) -> dt.datetime:
    """A look-back before the newest loaded change, at the start of that day.

    Late rows and those at the watermark are read again; merging them twice
    changes nothing.
    """
    last = newest(load.target.read(spark), load.change_time)
    day = last.date() if isinstance(last, dt.datetime) else last
    return dt.datetime.combine(day - WINDOW, dt.time())


def _load_one(spark: SparkSession, load: TableLoad, mode: str) -> int:
    """Read once, write once; the row count is taken while writing."""
    rows, since = load.source.read(spark), None
    if mode == "increment":
        since = _since(spark, load)
        rows = changed_or_undated(rows, load.change_time, since)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("records"))
    if mode == "full":
        load.target.replace(counted)
        return seen.get["records"]
    # The merge reads the changes twice; staged, the source still is read once.
    changes = stage(counted, f"changes-{load.name}")
    load.target.upsert(changes, since)
    return seen.get["records"]


def load_all(
    spark: SparkSession,
    loads: Sequence[TableLoad],
    jobs: JobStore | None = None,
    clock: Clock = dt.datetime.now,
) -> DataFrame:
    """Run every load; a failing table is recorded and the others go on.

    Returns one row per table. Table contents never pass through the driver.
    """
    runs, outcome = [], []
    for load in loads:
        started, mode, records, status, message = clock(), None, 0, "success", None
        try:
            mode = load_mode(spark, load)
            if jobs:
                config = JobConfig(
                    job_name=load.job_name,
                    source_schema=load.source_schema,
                    source_table=load.name,
                    destination_schema=load.layer,
                    destination_table=load.name,
                    load_type=mode,
                )
                jobs.append(config_records(spark, [config], clock()), "job_config")
            records = _load_one(spark, load, mode)
        except Exception as error:  # noqa: BLE001 - one table must not stop the rest
            status, message = "failed", str(error)
        ended = clock()
        run = JobRun(load.job_name, started, ended, records, status, message)
        if jobs:
            jobs.append(log_records(spark, [run], clock()), "job_log")
        runs.append(run)
        outcome.append((load.name, mode, status, records, round((ended - started).total_seconds()), message))
    return spark.createDataFrame(outcome, OUTCOME)


def summary(outcome: DataFrame) -> DataFrame:
    """One row: tables, successes, failures, rows and duration of a load."""
    return outcome.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("records").alias("records"),
        F.sum("seconds").alias("seconds"),
    )
