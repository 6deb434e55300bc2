"""Count-Min sketch whose state is a table of counters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash, with_positions
from stratoform.session import stage


@dataclass(frozen=True)
class CountMin:
    """Rows ``(line, bucket, total)`` for the non-zero counters.

    ``written`` says that they are in a table and need not be computed again.
    """

    cells: DataFrame
    width: int
    depth: int
    kind: Hash
    written: bool = False

    @classmethod
    def build(
        cls,
        df: DataFrame,
        column: str,
        weight: Column | None = None,
        width: int = 1000,
        depth: int = 5,
        kind: Hash = Hash.FAST,
    ) -> CountMin:
        """Sketch of the weights (default 1) of the non-null values of ``column``.

        A task holds at most ``width * depth`` counters and shuffles only
        those, so neither the number of items nor a hot item matters.
        """
        amount = F.lit(1) if weight is None else weight
        items = df.where(F.col(column).isNotNull()).select(column, amount.cast("bigint").alias("amount"))
        hashed, at = with_positions(items, column, depth, width, kind)
        cells = (
            hashed.select("amount", F.posexplode(F.array(*at)).alias("line", "bucket"))
            .groupBy("line", "bucket")
            .agg(F.sum("amount").alias("total"))
        )
        return cls(cells, width, depth, kind)

    @property
    def size_in_bytes(self) -> int:
        return self.width * self.depth * 8

    def merge(self, other: CountMin) -> CountMin:
        if (self.width, self.depth, self.kind) != (other.width, other.depth, other.kind):
            raise ValueError("sketches differ in width, depth or hash function")
        cells = self.cells.unionByName(other.cells).groupBy("line", "bucket").agg(F.sum("total").alias("total"))
        return replace(self, cells=cells, written=False)

    def stored(self) -> CountMin:
        """The same sketch with its counters written, for use in several queries."""
        return self if self.written else replace(self, cells=stage(self.cells, "countmin-cells"), written=True)

    def measured_bytes(self) -> DataFrame:
        """One row ``sketch_bytes``: of the counters that are there, as the table holds them."""
        return self.cells.agg((F.count(F.lit(1)) * 8).alias("sketch_bytes"))

    def estimate(self, df: DataFrame, column: str, output: str = "estimate") -> DataFrame:
        """``df`` with the estimated weight of each value; never below the true one.

        Each line of counters is joined by the value's counter in it; Spark
        ships a line to all tasks or shuffles both sides, as it does for any
        join. A null value has weight zero, as nulls are not counted.
        """
        cells = self.stored().cells
        met, at = with_positions(df, column, self.depth, self.width, self.kind)
        for line, position in enumerate(at):
            own = cells.where(F.col("line") == line).select(F.col("bucket").alias(f"_at{line}"), F.col("total").alias(f"_total{line}"))
            met = met.join(own, position == F.col(f"_at{line}"), "left")
        totals = [F.coalesce(f"_total{line}", F.lit(0).cast("bigint")) for line in range(self.depth)]
        return met.select(*df.columns, F.array_min(F.array(*totals)).alias(output))

    def save(self, path: str) -> None:
        self.cells.write.mode("overwrite").parquet(f"{path}/cells")
        meta = self.cells.sparkSession.createDataFrame(
            [(self.width, self.depth, str(self.kind))], "width bigint, depth int, kind string"
        )
        meta.write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CountMin:
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls(spark.read.parquet(f"{path}/cells"), meta["width"], meta["depth"], Hash(meta["kind"]))
