"""Sample rows of the sales star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash, bucket
from stratoform.functions.text import padded_key
from stratoform.model.schemas import schema_of

# Ranges of the generated sales.
FIRST_DAY = dt.date(2024, 1, 1)
DAYS = 365
MAX_QUANTITY = 5
MIN_PRICE_CENTS, MAX_PRICE_CENTS = 2_000, 150_000
MAX_DISCOUNT_PERCENT = 20


def rows_to_table(spark: SparkSession, table: str, rows: Sequence[dict]) -> DataFrame:
    """Literal rows as a star table; a column that a row leaves out is null."""
    schema = schema_of("star", table)
    unknown = {c for r in rows for c in r} - set(schema.names)
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def sales(
    numbers: DataFrame,
    number: str,
    customers: int,
    products: int,
    locations: int,
    created: dt.datetime | None = None,
    kind: Hash = Hash.FAST,
) -> DataFrame:
    """One sale per row of ``numbers``, every value derived from its number.

    Being a pure expression it runs in as many tasks as ``numbers`` has, and
    gives the same rows however those are partitioned.
    """

    def draw(what: str, choices: int) -> Column:
        return bucket(F.concat_ws(":", F.col(number).cast("string"), F.lit(what)), choices, kind)

    cents = draw("price", MAX_PRICE_CENTS - MIN_PRICE_CENTS + 1) + MIN_PRICE_CENTS
    drawn = numbers.select(
        padded_key("SALE", F.col(number), 6).alias("sale_id"),
        padded_key("CUST", draw("customer", customers) + 1, 3).alias("customer_id"),
        padded_key("PROD", draw("product", products) + 1, 3).alias("product_id"),
        padded_key("LOC", draw("location", locations) + 1, 3).alias("location_id"),
        F.date_add(F.lit(FIRST_DAY), draw("day", DAYS).cast("int")).alias("sale_date"),
        (draw("quantity", MAX_QUANTITY) + 1).cast("int").alias("quantity"),
        (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)").alias("unit_price"),
        draw("discount", MAX_DISCOUNT_PERCENT + 1).cast("decimal(2,0)").alias("_percent"),
    )
    total = (F.col("quantity").cast("decimal(2,0)") * F.col("unit_price")).cast("decimal(12,2)")
    discount = F.round(F.col("total_amount") * F.col("_percent") * F.lit("0.01").cast("decimal(2,2)"), 2)
    stamped = F.lit(created or dt.datetime.combine(FIRST_DAY, dt.time())).cast("timestamp")
    rows = (
        drawn.withColumn("total_amount", total)
        .withColumn("discount_amount", discount.cast("decimal(10,2)"))
        .withColumn("net_amount", (F.col("total_amount") - F.col("discount_amount")).cast("decimal(12,2)"))
        .withColumn("created_at", stamped)
    )
    return rows.select(*schema_of("star", "fact_sales").names)
