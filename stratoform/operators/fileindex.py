"""An index of the files of a Parquet table: which of them can hold a value.

For each file there is a row with the smallest and largest value of each
indexed column, and a Bloom filter of its values. A lookup asks the index first
and hands only the files found to the reader, so a file that cannot hold any
probe is not opened, not even for its footer.

A filter is cut into words of 64 bits, and a value has all its bits in one word.
The words of all files are one table, sorted by column and word: a probe meets
the words of its own number by an equi-join, one for each file, and a few
probes read only the row groups that hold their words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.operators.layout import write_sorted
from stratoform.session import is_there

BITS_PER_VALUE = 12
_BITS = 4
#: Probes up to this many are pushed down to the words as a list.
_LISTED = 200


def _word(value: Column, words: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 32).bitwiseAND(F.lit(words - 1)).cast("int")


def _mask(value: Column) -> Column:
    """The bits of a value in its word."""
    h = F.xxhash64(value)
    bits = [F.expr("cast(1 as bigint)") for _ in range(_BITS)]
    places = [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_BITS)]
    return reduce(Column.bitwiseOR, (F.call_function("shiftleft", one, at) for one, at in zip(bits, places, strict=True)))


@dataclass(frozen=True)
class FileIndex:
    """The index, at ``path``, of ``columns`` of the table at ``table``; ``words`` words for each file and column."""

    table: str
    path: str
    columns: tuple[str, ...]
    words: int

    @classmethod
    def build(cls, spark: SparkSession, table: str, path: str, columns: Sequence[str], rows_per_file: int | None = None) -> FileIndex:
        """Index all files; filters are sized for ``rows_per_file``, by default the mean."""
        if rows_per_file is None:
            read = spark.read.parquet(table)
            rows_per_file = max(1, read.count() // max(1, len(read.inputFiles())))
        words = 1 << max(0, (rows_per_file * BITS_PER_VALUE // 64).bit_length())
        index = cls(table, path, tuple(columns), words)
        index.refresh(spark)
        return index

    def refresh(self, spark: SparkSession) -> int:
        """Indexes the files that are not yet in the index, and only reads those; how many they were."""
        known = set(self._files(spark))
        new = [f for f in spark.read.parquet(self.table).inputFiles() if f not in known]
        if not new:
            return 0
        part = f"{self.path}/{uuid.uuid4().hex}"
        rows = spark.read.parquet(*new).select(*self.columns, F.input_file_name().alias("_file"))
        ends = [end(c).alias(f"{c}_{name}") for c in self.columns for end, name in ((F.min, "low"), (F.max, "high"))]
        values = [
            F.struct(
                F.lit(c).alias("column"),
                _word(F.col(c), self.words).alias("word"),
                _mask(F.col(c)).alias("bits"),
                F.col(c).isNotNull().alias("known"),
            )
            for c in self.columns
        ]
        words = rows.select("_file", F.explode(F.array(*values)).alias("v")).select("_file", "v.*").where("known")
        words = words.groupBy("_file", "column", "word").agg(F.bit_or("bits").alias("bits"))
        write_sorted(words, f"{part}/words", "column", "word")
        # What is written last is what counts: without it the part is no part of the index.
        listed = spark.createDataFrame([(f,) for f in new], "_file string")  # also those without rows
        files = listed.join(rows.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), *ends), "_file", "left")
        files.coalesce(1).write.parquet(f"{part}/files")
        return len(new)

    def _read(self, spark: SparkSession, kind: str) -> DataFrame | None:
        return spark.read.parquet(f"{self.path}/*/{kind}") if is_there(spark, self.path) else None

    def _files(self, spark: SparkSession) -> list[str]:
        files = self._read(spark, "files")
        return [] if files is None else [r[0] for r in files.select("_file").collect()]

    def files_between(self, spark: SparkSession, column: str, low: object, high: object) -> list[str]:
        """Files that may have a value from ``low`` to ``high``."""
        files = self._read(spark, "files").where((F.col(f"{column}_high") >= F.lit(low)) & (F.col(f"{column}_low") <= F.lit(high)))
        return [r[0] for r in files.select("_file").collect()]

    def files_with(self, probes: DataFrame, column: str) -> list[str]:
        """Files that may have one of the values of ``probes``' column of that name.

        A file is named if a probe is between its ends and has all its bits in
        the file's filter; names, one for each file at most, come to the driver.
        """
        spark = probes.sparkSession
        value = F.col(column)
        wanted = probes.where(value.isNotNull()).select(value.alias("_value")).distinct()
        wanted = wanted.select("_value", _word(F.col("_value"), self.words).alias("word"), _mask(F.col("_value")).alias("mask"))
        words = self._read(spark, "words").where(F.col("column") == column)
        few = [r.word for r in wanted.select("word").limit(_LISTED + 1).collect()]
        if not few:
            return []
        if len(few) <= _LISTED:
            words = words.where(F.col("word").isin(sorted(set(few))))
        ends = self._read(spark, "files").select("_file", F.col(f"{column}_low").alias("low"), F.col(f"{column}_high").alias("high"))
        hits = words.join(wanted, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        hits = hits.join(ends, "_file").where(F.col("_value").between(F.col("low"), F.col("high")))
        return [r[0] for r in hits.select("_file").distinct().collect()]

    def read(self, spark: SparkSession, files: Iterable[str]) -> DataFrame:
        """The rows of some of the table's files."""
        schema = spark.read.parquet(self.table).schema
        names = sorted(files)
        return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)

    def lookup(self, probes: DataFrame, column: str) -> DataFrame:
        """The table's rows that have one of the probes' values; other files are not opened."""
        wanted = probes.select(column).distinct()
        rows = self.read(probes.sparkSession, self.files_with(probes, column))
        return rows.join(wanted, rows[column] == wanted[column], "left_semi")
