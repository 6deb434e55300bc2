"""The change load as a stream that drains and stops.

File arrival replaces the watermark bookkeeping of the batch load: each run
takes the files it has not seen. The upsert is idempotent, so a batch that is
retried after a failure gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratoform.sources.changes import KeyedTable


def upsert_new_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: KeyedTable,
    checkpoint: str,
    pattern: str = "*.parquet",
) -> None:
    """Merge the Parquet files in folder ``path`` that no earlier run has merged."""

    def merge(batch: DataFrame, _: int) -> None:
        if target.exists(batch.sparkSession):
            target.upsert(batch)
        else:
            target.replace(batch)

    query = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .parquet(path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
