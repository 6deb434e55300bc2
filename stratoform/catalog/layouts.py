"""Reads served by a physical layout."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.analytics import target_customers, unknown_ids
from stratoform.catalog.registry import SINCE, query
from stratoform.catalog.sql import with_tables
from stratoform.model import views
from stratoform.operators.fileindex import FileIndex
from stratoform.operators.layout import RangeCopy, write_on_curve, write_sorted
from stratoform.session import scratch_path, stage

_COLUMNS = ("sale_id", "line_number", "product_id", "sale_date", "net_amount")
_SHOWN = "sale_id, line_number, product_id, sale_date, CAST(net_amount AS DOUBLE) AS net_amount"


def narrow_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales(spark, sf_dir).select(*_COLUMNS)


@query("ordered_range_read", with_tables(f"SELECT {_SHOWN} FROM recent", "recent"))
def ordered_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sales-by-date")
    write_sorted(narrow_sales(spark, sf_dir), path, "sale_date")
    return spark.read.parquet(path).where(F.col("sale_date") >= F.lit(SINCE)).orderBy("sale_date")


@query(
    "recent_subset_read",
    with_tables(f"SELECT {_SHOWN} FROM sales WHERE sale_date >= DATE '1999-06-01'", "sales"),
)
def recent_subset_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served by the copy of the recent sales, as its condition is implied."""
    base = narrow_sales(spark, sf_dir)
    copy = RangeCopy.write(base, scratch_path(spark, "recent-sales"), "sale_date", SINCE)
    return copy.read(base, dt.date(1999, 6, 1))


@query(
    "indexed_lookup",
    """SELECT o_custkey AS customer_id, count(*) AS orders FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE') GROUP BY 1""",
)
def indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups by key; half of the ids are unknown, and the files are named by the index."""
    known = target_customers(spark, sf_dir)
    probes = stage(known.unionByName(unknown_ids(known, "customer_id")), "probes")
    hits = orders_by_customer(spark, sf_dir).lookup(probes, "customer_id")
    return hits.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))


_INDEXED: dict[tuple[str, str], FileIndex] = {}


def orders_by_customer(spark: SparkSession, sf_dir: str) -> FileIndex:
    """The orders sorted by customer, with an index of the files; the application's first call writes both."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXED:
        path = scratch_path(spark, "orders-by-customer")
        write_sorted(views.buyers(spark, sf_dir), path, "customer_id")
        _INDEXED[key] = FileIndex.build(spark, path, scratch_path(spark, "order-files"), ["customer_id", "sale_id"])
    return _INDEXED[key]


@query(
    "indexed_lookup_of_a_few",
    """SELECT o_custkey AS customer_id, o_orderkey AS sale_id FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9900)""",
)
def indexed_lookup_of_a_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of the richest customers, from the files that have any."""
    probes = views.table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_custkey").alias("customer_id"))
    return orders_by_customer(spark, sf_dir).lookup(probes, "customer_id").select("customer_id", "sale_id")


#: Inclusive ranges, one for each column of the curve.
CURVE_RANGES = {
    "sale_date": (dt.date(1997, 3, 1), dt.date(1997, 3, 31)),
    "customer_id": (10, 20),
    "product_id": (5, 9),
}


def _between(column: str) -> str:
    low, high = (f"DATE '{v}'" if isinstance(v, dt.date) else str(v) for v in CURVE_RANGES[column])
    return f"""SELECT '{column}' AS range_of, sale_id, line_number, CAST(net_amount AS DOUBLE) AS net_amount
               FROM sales WHERE {column} BETWEEN {low} AND {high}"""


@query("curve_range_reads", with_tables(" UNION ALL ".join(_between(c) for c in CURVE_RANGES), "sales"))
def curve_range_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of each of three columns, from the files of one copy that the index names."""
    path, columns = scratch_path(spark, "sales-on-curve"), list(CURVE_RANGES)
    rows = stage(views.sales_with_customer(spark, sf_dir).select(*columns, "sale_id", "line_number", "net_amount"), "sales")
    write_on_curve(rows, path, columns, files=64)
    index = FileIndex.build(spark, path, scratch_path(spark, "curve-files"), columns)
    parts = []
    for column, (low, high) in CURVE_RANGES.items():
        found = index.read(spark, index.files_between(spark, column, low, high))
        found = found.where(F.col(column).between(F.lit(low), F.lit(high)))
        parts.append(found.select(F.lit(column).alias("range_of"), "sale_id", "line_number", "net_amount"))
    return reduce(DataFrame.unionByName, parts)
