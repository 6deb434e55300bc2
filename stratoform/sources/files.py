"""File and JDBC readers, text staging, table writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratoform.functions.text import blank_to_null

# The delimited format of the source files.
CSV_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_CSV_TIMES = {"timestampFormat": _TIMESTAMP, "timestampNTZFormat": _TIMESTAMP}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Delimited file with a header that must name the columns of ``schema``.

    An empty value is null, quoted or not.
    """
    options = {**CSV_FORMAT, **_CSV_TIMES, "enforceSchema": "false", "mode": "FAILFAST"}
    return spark.read.options(**options).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    # Blanks around a value belong to it.
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    options = {**CSV_FORMAT, **_CSV_TIMES, **blanks}
    df.write.mode("overwrite").options(**options).csv(path)


def read_text_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Delimited file with every column as text, for typing later."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.options(**CSV_FORMAT).schema(schema).csv(path)


@dataclass(frozen=True)
class TypedLoad:
    """Outcome of typing text columns; both sides are lazy."""

    accepted: DataFrame
    rejected: DataFrame


def type_text_columns(staged: DataFrame, types: Mapping[str, str], required: Sequence[str]) -> TypedLoad:
    """Blank text becomes null, the rest is cast.

    A row is rejected with the names of the columns whose text does not parse
    (``unparsed``) and of the required ones without a value (``missing``).
    """
    text = {c: blank_to_null(F.col(c)) for c in types}
    typed = {c: text[c].try_cast(t) for c, t in types.items()}
    unparsed = F.filter(
        F.array(*[F.when(text[c].isNotNull() & typed[c].isNull(), c) for c in types]),
        lambda c: c.isNotNull(),
    )
    missing = F.filter(
        F.array(*[F.when(text[c].isNull(), c) for c in required], F.lit(None).cast("string")), lambda c: c.isNotNull()
    )
    good = (F.size(unparsed) == 0) & (F.size(missing) == 0)
    accepted = staged.where(good).select(*[typed[c].alias(c) for c in types])
    reasons = {"unparsed": F.array_join(unparsed, ","), "missing": F.array_join(missing, ",")}
    return TypedLoad(accepted, staged.where(~good).withColumns(reasons))


class Source:
    """Where a table's rows come from."""

    def read(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class ParquetSource(Source):
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


@dataclass(frozen=True)
class FrameSource(Source):
    """A DataFrame built elsewhere, such as a filtered or joined source."""

    frame: DataFrame

    def read(self, spark: SparkSession) -> DataFrame:
        return self.frame


@dataclass(frozen=True)
class TableSource(Source):
    name: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


@dataclass(frozen=True)
class JdbcSource(Source):
    """Database table read in parallel ranges of a numeric or time column.

    Without ``partition_column`` the whole table comes through one connection,
    so give it for anything large. Filters on the result reach the database.
    """

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int = 1
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        opts = {
            "url": self.url,
            "dbtable": self.table,
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
            **self.properties,
        }
        if self.partition_column:
            opts |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower),
                "upperBound": str(self.upper),
                "numPartitions": str(self.partitions),
            }
        return opts

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options()).load()


def count_tables(tables: Mapping[str, DataFrame], total: str = "TOTAL") -> DataFrame:
    """Rows ``(table_name, records)`` per table and for all together."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name, df in tables.items()
    ]
    every = reduce(DataFrame.unionByName, counts)
    # One pass gives both levels; the null of the rollup is the total.
    return (
        every.rollup("table_name")
        .agg(F.sum("records").alias("records"))
        .select(F.coalesce("table_name", F.lit(total)).alias("table_name"), "records")
    )


def preview(df: DataFrame, order: Sequence[Column | str], rows: int = 10) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
