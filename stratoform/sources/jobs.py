"""Job configuration and job log records."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratoform.functions.text import log_text
from stratoform.model.schemas import schema_of

# How the configuration table stores the load type.
LOAD_TYPES = {"full": 0, "increment": 1}


@dataclass(frozen=True)
class JobRun:
    job_name: str
    start_time: dt.datetime
    end_time: dt.datetime
    record_count: int
    status: str
    error_message: str | None = None


@dataclass(frozen=True)
class JobConfig:
    job_name: str
    source_schema: str
    source_table: str
    destination_schema: str
    destination_table: str
    load_type: str
    source_db_type: str = "postgres"
    source_ip: str = "localhost"
    destination_db_type: str = "spark"
    destination_ip: str = "localhost"
    schedule_type: str = "manual"
    is_active: int = 1


def log_records(spark: SparkSession, runs: list[JobRun], created: dt.datetime) -> DataFrame:
    """Log rows, one per finished run. The schema is declared as a message may be null in all."""
    rows = [
        (
            str(uuid.uuid4()),
            r.job_name,
            r.start_time.date(),
            r.start_time,
            r.end_time,
            r.record_count,
            r.status,
            r.error_message,
            created,
        )
        for r in runs
    ]
    return spark.createDataFrame(rows, schema_of("jobs", "job_log"))


def config_records(spark: SparkSession, configs: list[JobConfig], created: dt.datetime) -> DataFrame:
    rows = [
        (
            str(uuid.uuid4()),
            c.job_name,
            c.source_schema,
            c.source_table,
            c.source_db_type,
            c.source_ip,
            c.destination_schema,
            c.destination_table,
            c.destination_db_type,
            c.destination_ip,
            LOAD_TYPES[c.load_type],
            c.schedule_type,
            c.is_active,
            created,
        )
        for c in configs
    ]
    return spark.createDataFrame(rows, schema_of("jobs", "job_config"))


@dataclass(frozen=True)
class JobStore:
    """Where job records are appended: a Parquet folder each, or a database.

    A database column has a fixed width and gets what fits; the folder keeps all.
    """

    path: str | None = None
    jdbc: Mapping[str, str] | None = None

    def append(self, df: DataFrame, table: str) -> None:
        # A handful of rows: one file per append, not one per default partition.
        rows = df.coalesce(1)
        if self.jdbc:
            texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)]
            rows = rows.withColumns({c: log_text(F.col(c)) for c in texts})
            rows.write.format("jdbc").options(dbtable=table, **self.jdbc).mode("append").save()
        else:
            rows.write.mode("append").parquet(f"{self.path}/{table}")
