"""Analytical queries on the sales star.

A query that groups by an attribute of a dimension first adds up the fact by
the dimension's key. The join then sees one row per key, a hot key is reduced
before any shuffle, and distinct members are plain counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.functions.amounts import mean


def since(sales: DataFrame, day: dt.date) -> DataFrame:
    return sales.where(F.col("sale_date") >= F.lit(day))


def totals(sales: DataFrame, *keys: str | Column) -> DataFrame:
    """Additive measures per key: line count, pieces, net amount, price sum."""
    return sales.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("pieces"),
        F.sum("net_amount").alias("net"),
        F.sum("unit_price").alias("price_sum"),
    )


def roll_up(parts: DataFrame, *keys: str | Column) -> DataFrame:
    """Measures of ``totals`` on coarser keys."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("lines", "pieces", "net", "price_sum")])


def daily_sales(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "sale_date")
        .select(
            "sale_date",
            F.col("lines").alias("total_sales"),
            F.col("net").alias("total_revenue"),
            mean(F.col("net"), F.col("lines")).alias("avg_sale_amount"),
        )
        .orderBy("sale_date")
    )


def customer_analysis(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Per region; ``by_customer`` has the totals per ``customer_id``."""
    members = customers.select("customer_id", "region").join(by_customer, "customer_id")
    return (
        members.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("lines").alias("total_sales"),
            F.sum("net").alias("total_revenue"),
        )
        .withColumn("avg_purchase", mean(F.col("total_revenue"), F.col("total_sales")))
        .orderBy(F.desc("total_revenue"))
    )


def customer_segmentation(by_customer: DataFrame, customers: DataFrame, segment: str = "gender") -> DataFrame:
    """Per region and segment, for those with any sale."""
    members = customers.select("customer_id", "region", segment).join(by_customer, "customer_id")
    return (
        members.groupBy("region", segment)
        .agg(
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("net").alias("total_revenue"),
            F.sum("lines").alias("_lines"),
        )
        .where("_lines > 0")
        .withColumn("avg_purchase_amount", mean(F.col("total_revenue"), F.col("_lines")))
        .drop("_lines")
        .orderBy(F.desc("total_revenue"))
    )


def product_performance(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Per category; ``by_product`` has the totals per ``product_id``."""
    members = products.select("product_id", "category_name").join(by_product, "product_id")
    return (
        roll_up(members, "category_name")
        .select(
            "category_name",
            F.col("lines").alias("total_sales"),
            F.col("pieces").alias("total_quantity"),
            F.col("net").alias("total_revenue"),
            mean(F.col("price_sum"), F.col("lines")).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def top_customers(
    by_customer: DataFrame, customers: DataFrame, more_than: int = 5, rows: int = 10
) -> DataFrame:
    """The biggest spenders among customers with more than that many purchases."""
    return (
        by_customer.where(F.col("lines") > more_than)
        .join(customers.select("customer_id", "customer_name", "region"), "customer_id")
        .orderBy(F.desc("net"), "customer_id")
        .limit(rows)
        .select(
            "customer_name",
            "region",
            F.col("lines").alias("purchase_count"),
            F.col("net").alias("total_spent"),
        )
    )


def monthly_trends(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, F.year("sale_date").alias("year"), F.month("sale_date").alias("month"))
        .select(
            F.col("year").cast("bigint").alias("year"),
            F.col("month").cast("bigint").alias("month"),
            F.col("lines").alias("sales_count"),
            F.col("net").alias("monthly_revenue"),
            mean(F.col("net"), F.col("lines")).alias("avg_sale_amount"),
        )
        .orderBy("year", "month")
    )


def daily_by_region(located_sales: DataFrame) -> DataFrame:
    """Per day and region; the sales already carry the region of their customer."""
    return (
        totals(located_sales, "sale_date", "region")
        .select(
            "sale_date",
            "region",
            F.col("lines").alias("total_sales"),
            F.col("net").alias("total_revenue"),
            mean(F.col("net"), F.col("lines")).alias("avg_sale_amount"),
        )
        .orderBy("sale_date", "region")
    )


def in_regions(customers: DataFrame, regions: Sequence[str]) -> DataFrame:
    return customers.where(F.col("region").isin(*regions))


def bought_pairs(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct (customer, product) pairs among the target customers and products."""
    wanted = sales.join(customers, "customer_id", "left_semi").join(products, "product_id", "left_semi")
    return distinct_pairs(wanted)


def distinct_pairs(sales: DataFrame) -> DataFrame:
    return sales.select("customer_id", "product_id").distinct()


def distinct_customers(sales: DataFrame, subsets: dict[str, Column]) -> DataFrame:
    """Rows ``(subset, customers)``: exact distinct customers under each condition.

    One pass: each customer keeps one flag per condition, the flags are counted.
    """
    names = list(subsets)
    flags = sales.groupBy("customer_id").agg(
        *[F.max(F.coalesce(test, F.lit(False))).alias(f"_{i}") for i, test in enumerate(subsets.values())]
    )
    counted = flags.where(F.col("customer_id").isNotNull()).agg(
        *[F.count_if(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(names))]
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("subset"), F.col(f"_{i}").alias("customers")) for i, n in enumerate(names)]
    )
    return counted.select(F.explode(pairs).alias("pair")).select("pair.*")


def lookup(probes: DataFrame, key: str, by_key: DataFrame) -> DataFrame:
    """For each probed key whether it has sales, and how many; from the totals per key."""
    found = probes.select(key).distinct().join(by_key.select(key, "lines"), key, "left")
    count = F.coalesce("lines", F.lit(0).cast("bigint"))
    return found.select(key, (count > 0).alias("found"), count.alias("sale_count"))


def having_row(sales: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Sales whose key exists in the dimension."""
    return sales.join(dimension.select(key), key, "left_semi")
