"""Keys, versions and the gold star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.cleansing import silver
from stratoform.catalog.registry import query
from stratoform.catalog.sql import tables, with_tables
from stratoform.functions.dates import day_before
from stratoform.model import views
from stratoform.operators.keys import KeyRegistry
from stratoform.operators.latest import latest_per_key
from stratoform.operators.numbering import with_row_numbers
from stratoform.operators.versions import with_next_start, with_version_in_force
from stratoform.plans import gold
from stratoform.session import scratch_path, stage
from stratoform.sources.files import count_tables, preview


@query(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
              (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(views.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "dedupe_by_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
              (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(views.table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = views.customer_versions(spark, sf_dir)
    ended = with_next_start(versions, "customer_id", "start_date", ["version_id"])
    return ended.withColumn("end_date", day_before(F.col("next_start")))


@query(
    "scd_end_date",
    with_tables(
        "SELECT customer_id, version_id, start_date, CAST(next_start - 1 AS DATE) AS end_date FROM versions", "versions"
    ),
)
def scd_end_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_versions(spark, sf_dir).select("customer_id", "version_id", "start_date", "end_date")


@query(
    "version_in_force",
    with_tables(
        """SELECT sale_id, line_number, s.customer_id, sale_date, version_id, priority
           FROM sales s LEFT JOIN versions v ON v.customer_id = s.customer_id AND start_date <= sale_date
                AND (next_start IS NULL OR sale_date < next_start)""",
        "sales",
        "versions",
    ),
)
def version_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales_with_customer(spark, sf_dir).select("sale_id", "line_number", "customer_id", "sale_date")
    return with_version_in_force(
        sales,
        views.customer_versions(spark, sf_dir),
        "customer_id",
        "sale_date",
        "start_date",
        ["version_id"],
        ["version_id", "priority"],
    )


@query(
    "surrogate_key_customers",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS customer_name
       FROM customer""",
)
def surrogate_key_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )
    return with_row_numbers(customers, ["customer_id"], "customer_key")


@query(
    "surrogate_key_products",
    with_tables(
        """SELECT row_number() OVER (ORDER BY prd_start_dt, prd_key, prd_id) AS product_key, prd_start_dt, prd_key, prd_id
           FROM silver_products""",
        "silver_products",
    ),
)
def surrogate_key_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = silver(spark, sf_dir, "crm_prd_info").select("prd_start_dt", "prd_key", "prd_id")
    return with_row_numbers(products, ["prd_start_dt", "prd_key", "prd_id"], "product_key")


@query(
    "surrogate_keys_that_last",
    """SELECT row_number() OVER (ORDER BY c_custkey % 3 = 1, c_custkey) AS customer_key, c_custkey AS customer_id
       FROM customer""",
)
def surrogate_keys_that_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys after a load of two thirds of the customers, one of all, and a repeated one."""
    keys = KeyRegistry(scratch_path(spark, "customer-keys"), ("customer_id",), "customer_key")
    customers = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    for load in (customers.where("customer_id % 3 <> 1"), customers, customers):
        keys.assign(load)
    return keys.read(spark)


_LASTING = """product_keys AS (
                  SELECT row_number() OVER (ORDER BY product_id % 2 = 1, start_date, product_number, product_id) AS lasting_key, *
                  FROM gold_products),
              customer_keys AS (
                  SELECT row_number() OVER (ORDER BY customer_id % 3 = 1, customer_id) AS lasting_key, * FROM gold_customers),
              loads AS (SELECT *, coalesce(sls_order_dt >= DATE '1996-01-01', true) AS late FROM silver_sales)"""


@query(
    "fact_sales_with_lasting_keys",
    f"""{tables("silver_sales", "gold_products", "gold_customers")}, {_LASTING}
        SELECT sls_ord_num AS order_number, p.lasting_key AS product_key, c.lasting_key AS customer_key,
               sls_order_dt AS order_date, sls_ship_dt AS shipping_date, sls_due_dt AS due_date,
               sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS unit_price
        FROM loads LEFT JOIN product_keys p ON sls_prd_key = product_number AND start_date <= sls_order_dt
                  AND (end_date IS NULL OR sls_order_dt <= end_date) AND (late OR product_id % 2 = 0)
             LEFT JOIN customer_keys c ON sls_cust_id = customer_id AND (late OR customer_id % 3 <> 1)""",
)
def fact_sales_with_lasting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of two loads, each stored with the keys of its time; the first knows half the products."""
    keys = gold.GoldKeys(scratch_path(spark, "gold-keys"))
    names = ("crm_cust_info", "erp_cust_az12", "erp_loc_a101", "crm_prd_info", "erp_px_cat_g1v2", "crm_sales_details")
    clean = {name: stage(silver(spark, sf_dir, name), name) for name in names}
    late = F.coalesce(F.col("sls_order_dt") >= F.lit(dt.date(1996, 1, 1)), F.lit(True))
    first = clean | {
        "crm_cust_info": clean["crm_cust_info"].where("cst_id % 3 <> 1"),
        "crm_prd_info": clean["crm_prd_info"].where("prd_id % 2 = 0"),
        "crm_sales_details": clean["crm_sales_details"].where(~late),
    }
    loaded = []
    for load in (first, clean | {"crm_sales_details": clean["crm_sales_details"].where(late)}):
        keys.assign(load)
        dimensions = gold.build_dimensions(load, keys)
        facts = gold.fact_sales_as_of(load["crm_sales_details"], dimensions["dim_products"], dimensions["dim_customers"])
        loaded.append(stage(facts, "facts"))
    return loaded[0].unionByName(loaded[1])


def gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customers(
        *[silver(spark, sf_dir, t) for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")]
    )


def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_products(*[silver(spark, sf_dir, t) for t in ("crm_prd_info", "erp_px_cat_g1v2")])


def gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_sales(
        silver(spark, sf_dir, "crm_sales_details"), gold_products(spark, sf_dir), gold_customers(spark, sf_dir)
    )


@query("dim_customers", with_tables("SELECT * FROM gold_customers", "gold_customers"))
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_customers(spark, sf_dir)


@query("dim_products", with_tables("SELECT * FROM gold_products", "gold_products"))
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_products(spark, sf_dir)


@query("fact_sales", with_tables("SELECT * FROM gold_sales", "gold_sales"))
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_sales(spark, sf_dir)


@query(
    "fact_sales_asof",
    with_tables(
        """SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
                  sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
                  sls_quantity AS quantity, sls_price AS unit_price
           FROM silver_sales LEFT JOIN gold_products ON sls_prd_key = product_number AND start_date <= sls_order_dt
                AND (end_date IS NULL OR sls_order_dt <= end_date)
                LEFT JOIN gold_customers ON sls_cust_id = customer_id""",
        "silver_sales",
        "gold_products",
        "gold_customers",
    ),
)
def fact_sales_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_sales_as_of(
        silver(spark, sf_dir, "crm_sales_details"), gold_products(spark, sf_dir), gold_customers(spark, sf_dir)
    )


@query(
    "gold_counts",
    with_tables(
        """SELECT 'dim_customers' AS table_name, count(*) AS records FROM gold_customers
           UNION ALL SELECT 'dim_products', count(*) FROM gold_products
           UNION ALL SELECT 'fact_sales', count(*) FROM gold_sales
           UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM gold_customers) + (SELECT count(*) FROM gold_products)
                                     + (SELECT count(*) FROM gold_sales)""",
        "gold_sales",
    ),
)
def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = gold_customers(spark, sf_dir), gold_products(spark, sf_dir)
    sales = gold.fact_sales(silver(spark, sf_dir, "crm_sales_details"), products, customers)
    return count_tables({"dim_customers": customers, "dim_products": products, "fact_sales": sales})


@query(
    "gold_preview",
    with_tables("SELECT * FROM gold_customers ORDER BY customer_key LIMIT 10", "gold_customers"),
)
def gold_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_customers(spark, sf_dir), ["customer_key"])


@query(
    "gold_preview_products",
    with_tables("SELECT * FROM gold_products ORDER BY product_key LIMIT 10", "gold_products"),
)
def gold_preview_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_products(spark, sf_dir), ["product_key"])


_SALE_ORDER = [
    "order_number",
    "product_key",
    "customer_key",
    "order_date",
    "shipping_date",
    "due_date",
    "sales_amount",
    "quantity",
    "unit_price",
]


@query(
    "gold_preview_sales",
    with_tables(
        f"SELECT * FROM gold_sales ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _SALE_ORDER)} LIMIT 10", "gold_sales"
    ),
)
def gold_preview_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_sales(spark, sf_dir), _SALE_ORDER)
