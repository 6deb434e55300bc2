"""Logical warehouse tables over a folder of order, customer and part tables.

The folder holds ``region nation customer supplier part orders lineitem
events`` as Parquet. Each function below presents part of it as one of the
warehouse's tables. The raw tables come with the flaws that the cleansing
transforms are for: padded codes, integer dates with zeros, broken amounts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.functions.amounts import money, net_amount, rounded_unit_price
from stratoform.plans.sales import roll_up, totals

# Columns and types of the given tables. Declared, so that no file
# is opened just to learn its schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
               p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
                   l_quantity double, l_extendedprice double, l_discount double, l_tax double,
                   l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
                 props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


# --- sales star ------------------------------------------------------------


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without its customer, which is all that many queries need."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("location_id"),
        F.to_date("l_shipdate").alias("sale_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        rounded_unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        money(F.col("l_extendedprice")).alias("total_amount"),
        net_amount(F.col("l_extendedprice"), F.col("l_discount")).alias("net_amount"),
    )


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer of each sale."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id")
    )


def sales_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).join(buyers(spark, sf_dir), "sale_id")


def located_sales(fact: DataFrame, buyers_of: DataFrame, customers: DataFrame, *attributes: str) -> DataFrame:
    """Sales with attributes of their customer.

    The attributes are joined to the sale's header first, so the lines are
    shuffled once, by sale, and only those of wanted customers go on.
    """
    headers = buyers_of.join(customers.select("customer_id", *attributes), "customer_id")
    return fact.join(headers, "sale_id")


def totals_by_customer(fact: DataFrame, buyers_of: DataFrame) -> DataFrame:
    """Totals per customer, adding up the lines of a sale before looking up its buyer."""
    return roll_up(totals(fact, "sale_id").join(buyers_of, "sale_id"), "customer_id")


def totals_of_buyers(fact: DataFrame, headers: DataFrame) -> DataFrame:
    """Totals per customer of a few wanted sales, whose lines are picked before anything is added up."""
    return totals(fact.join(headers.select("sale_id", "customer_id"), "sale_id"), "customer_id")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, places = table(spark, sf_dir, "customer"), _places(spark, sf_dir)
    return customer.join(places, customer["c_nationkey"] == places["n_nationkey"]).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "region",
        "country",
        F.col("c_mktsegment").alias("gender"),
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category_id"),
        F.col("p_type").alias("category_name"),
        money(F.col("p_retailprice")).alias("list_price"),
    )


def dim_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, places = table(spark, sf_dir, "supplier"), _places(spark, sf_dir)
    return supplier.join(places, supplier["s_nationkey"] == places["n_nationkey"]).select(
        F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("location_name"), "region", "country"
    )


# --- changes and versions --------------------------------------------------


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order starts a new version of its customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("version_id"),
        F.to_date("o_orderdate").alias("start_date"),
        F.col("o_orderpriority").alias("priority"),
    )


def _changed_at(day: Column, number: Column) -> Column:
    """A change time that differs between the orders of a day."""
    return (day + F.make_dt_interval(secs=number % 1_000_000)).cast("timestamp")


def _cycle(number: Column, choices: Sequence[str | None]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number % len(choices) + 1).cast("int"))


def _long_tail(chosen: Column, number: Column) -> Column:
    """For some keys an end that makes them long and differs in its last character only."""
    return F.when(chosen, F.concat(F.lit("x" * 110), number.cast("string"))).otherwise("")


# --- raw tables of the layered warehouse -----------------------------------


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order delivers a record of its customer; every 101st has lost the id."""
    orders = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        F.when(key % 101 != 0, cust).alias("cst_id"),
        F.format_string("AW%08d", cust).alias("cst_key"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("cst_firstname"),
        F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("cst_lastname"),
        _cycle(key, [" s", "M ", "S", "m", "x", None]).alias("cst_marital_status"),
        _cycle(key, ["f", " M", "F ", "n/a", None]).alias("cst_gndr"),
        F.to_date("o_orderdate").alias("cst_create_date"),
        _changed_at(F.col("o_orderdate"), key).alias("src_update_at"),
    )


# Three versions share a product key; its category depends on the key.
_CATEGORIES = ("AC-HE", "BI-MB", "CL-GL", "CO-PE")


def _product_group(part: Column) -> Column:
    return F.call_function("div", part, F.lit(3).cast("bigint"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    group = _product_group(key)
    started = F.lit("1994-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days=(key % 3 * 900 + group % 300).cast("int")
    )
    return part.select(
        key.alias("prd_id"),
        F.concat(_cycle(group, _CATEGORIES), F.lit("-P"), group.cast("string"), _long_tail(group % 50 == 7, key % 2)).alias(
            "prd_key"
        ),
        F.col("p_name").alias("prd_nm"),
        F.when(key % 41 == 0, "12x").when(key % 29 != 0, money(F.col("p_retailprice")).cast("string")).alias("prd_cost"),
        _cycle(key, ["M ", "r", "S ", " t", "z", None]).alias("prd_line"),
        started.cast("timestamp").alias("prd_start_dt"),
        F.lit(None).cast("timestamp").alias("prd_end_dt"),
        started.cast("timestamp").alias("src_update_at"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with dates as integers, some zero or short, and measures that disagree."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    pieces = F.col("l_quantity").cast("int")
    amount = F.floor("l_extendedprice").cast("int")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int")

    def as_int(day: Column) -> Column:
        return F.year(day) * 10_000 + F.month(day) * 100 + F.day(day)

    ordered = as_int(F.col("o_orderdate"))
    return joined.select(
        F.concat(F.lit("SO"), key.cast("string")).alias("sls_ord_num"),
        F.concat(F.lit("P"), _product_group(F.col("l_partkey")).cast("string")).alias("sls_prd_key"),
        F.col("o_custkey").alias("sls_cust_id"),
        F.when(key % 17 == 0, 0).when(key % 19 == 0, ordered % 1_000_000).otherwise(ordered).alias("sls_order_dt"),
        F.when(key % 23 == 0, 20131340).otherwise(as_int(F.col("l_shipdate"))).alias("sls_ship_dt"),
        F.when(key % 31 != 0, as_int(F.date_add("o_orderdate", 30))).alias("sls_due_dt"),
        F.when(number == 2, -amount).when(number != 3, amount).alias("sls_sales"),
        F.when(number == 6, 0).otherwise(pieces).alias("sls_quantity"),
        F.when(number == 4, -price).when(number != 5, price).alias("sls_price"),
        _changed_at(F.col("l_shipdate"), key).alias("src_update_at"),
    )


def raw_erp_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    prefix = F.when(key % 2 == 0, "NAS").otherwise("")
    born = F.date_add(F.lit("1940-01-01").cast("date"), (key * 37 % 25_000).cast("int"))
    return orders.select(
        F.concat(prefix, F.format_string("AW%08d", cust), _long_tail(key % 40 == 0, key % 3)).alias("cid"),
        F.when(key % 50 == 0, F.lit("2999-01-01").cast("date")).otherwise(born).alias("bdate"),
        _cycle(key, ["female ", "M", "F", " Male", "", None, "x"]).alias("gen"),
        _changed_at(F.col("o_orderdate"), key).alias("src_update_at"),
    )


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    dash = F.when(key % 2 == 0, "-").otherwise("")
    return orders.select(
        F.concat(F.lit("AW"), dash, F.lpad(cust.cast("string"), 8, "0")).alias("cid"),
        _cycle(key, [" DE ", "USA ", "US", "us", " ", None, " France"]).alias("cntry"),
        _changed_at(F.col("o_orderdate"), key).alias("src_update_at"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part delivers its category; the fourth one comes under a code that no product has."""
    part = table(spark, sf_dir, "part")
    group = _product_group(F.col("p_partkey"))
    code = F.regexp_replace(_cycle(group, [*_CATEGORIES[:-1], "XX-XX"]), "-", "_")
    return part.select(
        code.alias("id"),
        F.substring(code, 1, 2).alias("cat"),
        F.col("p_type").alias("subcat"),
        _cycle(F.col("p_partkey"), ["Yes", "No"]).alias("maintenance"),
        (
            F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=F.col("p_partkey") % 1_000_000)
        )
        .cast("timestamp")
        .alias("src_update_at"),
    )


BRONZE = {
    "crm_cust_info": raw_customers,
    "crm_prd_info": raw_products,
    "crm_sales_details": raw_sales,
    "erp_cust_az12": raw_erp_customers,
    "erp_loc_a101": raw_locations,
    "erp_px_cat_g1v2": raw_categories,
}


def bronze(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: BRONZE[name](spark, sf_dir) for name in (names or BRONZE)}
