"""Data-quality checks on the raw, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.cleansing import silver
from stratoform.catalog.modelling import customer_versions, gold_customers, gold_products
from stratoform.catalog.registry import query
from stratoform.catalog.sql import with_tables
from stratoform.model import views
from stratoform.plans import gold
from stratoform.plans import quality as checks


@query(
    "dq_spaces",
    with_tables(
        "SELECT cst_marital_status FROM raw_customers WHERE cst_marital_status <> trim(cst_marital_status)",
        "raw_customers",
    ),
)
def dq_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.untrimmed(views.raw_customers(spark, sf_dir), "cst_marital_status")


@query(
    "dq_domain_status",
    with_tables("SELECT DISTINCT cst_marital_status FROM silver_customers", "silver_customers"),
)
def dq_domain_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.domain(silver(spark, sf_dir, "crm_cust_info"), "cst_marital_status")


@query(
    "dq_outside_domain_status",
    with_tables(
        """SELECT DISTINCT cst_marital_status FROM silver_customers
           WHERE cst_marital_status IS NULL OR cst_marital_status NOT IN ('Married', 'Single')""",
        "silver_customers",
    ),
)
def dq_outside_domain_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = silver(spark, sf_dir, "crm_cust_info")
    return checks.outside_domain(customers, "cst_marital_status", ["Married", "Single"])


@query(
    "dq_interval_order",
    with_tables(
        """SELECT customer_id, version_id, start_date, CAST(next_start - 1 AS DATE) AS end_date FROM versions
           WHERE next_start - 1 < start_date""",
        "versions",
    ),
)
def dq_interval_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = customer_versions(spark, sf_dir).select("customer_id", "version_id", "start_date", "end_date")
    return checks.reversed_interval(versions, "start_date", "end_date")


@query(
    "dq_date_order",
    with_tables(
        "SELECT * FROM silver_sales WHERE sls_order_dt > sls_ship_dt OR sls_order_dt > sls_due_dt", "silver_sales"
    ),
)
def dq_date_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = silver(spark, sf_dir, "crm_sales_details").drop("dwh_create_date")
    return checks.reversed_dates(sales, "sls_order_dt", ["sls_ship_dt", "sls_due_dt"])


@query(
    "dq_int_dates",
    with_tables(
        """SELECT nullif(sls_order_dt, 0) AS sls_order_dt FROM raw_sales
           WHERE sls_order_dt <= 0 OR length(CAST(sls_order_dt AS VARCHAR)) <> 8
              OR sls_order_dt > 20500101 OR sls_order_dt < 19000101""",
        "raw_sales",
    ),
)
def dq_int_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.bad_int_dates(views.raw_sales(spark, sf_dir), "sls_order_dt")


@query(
    "dq_sales_consistency",
    with_tables(
        """SELECT DISTINCT sls_sales, sls_quantity, sls_price FROM silver_sales
           WHERE sls_sales <> sls_quantity * sls_price OR sls_sales IS NULL OR sls_quantity IS NULL
              OR sls_price IS NULL OR sls_sales <= 0 OR sls_quantity <= 0 OR sls_price <= 0""",
        "silver_sales",
    ),
)
def dq_sales_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = silver(spark, sf_dir, "crm_sales_details")
    return checks.inconsistent_amounts(sales, "sls_sales", "sls_quantity", "sls_price")


@query(
    "dq_domain_country", with_tables("SELECT DISTINCT cntry FROM silver_locations", "silver_locations")
)
def dq_domain_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.domain(silver(spark, sf_dir, "erp_loc_a101"), "cntry").orderBy("cntry")


@query(
    "dq_domain_flag",
    with_tables("SELECT DISTINCT maintenance FROM silver_categories", "silver_categories"),
)
def dq_domain_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.domain(silver(spark, sf_dir, "erp_px_cat_g1v2"), "maintenance")


@query(
    "dq_unique_customer",
    with_tables(
        """SELECT customer_key, count(*) AS duplicate_count FROM gold_customers GROUP BY customer_key
           HAVING count(*) > 1""",
        "gold_customers",
    ),
)
def dq_unique_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(gold_customers(spark, sf_dir), "customer_key")


@query(
    "dq_unique_product",
    with_tables(
        """SELECT product_key, count(*) AS duplicate_count FROM gold_products GROUP BY product_key
           HAVING count(*) > 1""",
        "gold_products",
    ),
)
def dq_unique_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(gold_products(spark, sf_dir), "product_key")


@query(
    "dq_duplicate_raw_customers",
    with_tables(
        "SELECT cst_id, count(*) AS duplicate_count FROM raw_customers GROUP BY cst_id HAVING count(*) > 1",
        "raw_customers",
    ),
)
def dq_duplicate_raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(views.raw_customers(spark, sf_dir), "cst_id")


def sales_as_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fact with one product version per sale, and its two dimensions."""
    customers, products = gold_customers(spark, sf_dir), gold_products(spark, sf_dir)
    return gold.fact_sales_as_of(silver(spark, sf_dir, "crm_sales_details"), products, customers), products, customers


_AS_OF = """SELECT sls_ord_num AS order_number, product_key, customer_key, sls_quantity AS quantity
            FROM silver_sales LEFT JOIN gold_products ON sls_prd_key = product_number AND start_date <= sls_order_dt
                 AND (end_date IS NULL OR sls_order_dt <= end_date)
                 LEFT JOIN gold_customers ON sls_cust_id = customer_id"""


@query(
    "dq_orphans",
    with_tables(
        f"""SELECT order_number, product_key, customer_key, quantity FROM ({_AS_OF})
            WHERE product_key IS NULL OR product_key NOT IN (SELECT product_key FROM gold_products)""",
        "silver_sales",
        "gold_products",
        "gold_customers",
    ),
)
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, products, _ = sales_as_of(spark, sf_dir)
    lines = sales.select("order_number", "product_key", "customer_key", "quantity")
    return checks.orphans(lines, "product_key", products, "product_key")


@query(
    "dq_connectivity",
    with_tables(
        f"""SELECT order_number, quantity, customer_number, country, product_name, category_name
            FROM ({_AS_OF}) f LEFT JOIN gold_customers c ON c.customer_key = f.customer_key
                 LEFT JOIN gold_products p ON p.product_key = f.product_key""",
        "silver_sales",
        "gold_products",
        "gold_customers",
    ),
)
def dq_connectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, products, customers = sales_as_of(spark, sf_dir)
    return checks.connectivity(
        sales,
        {
            "customer_key": customers.select("customer_key", "customer_number", "country"),
            "product_key": products.select("product_key", "product_name", "category_name"),
        },
        ["order_number", "quantity", "customer_number", "country", "product_name", "category_name"],
    )


_CONSTRAINTS = {
    "primary key of lineitem": "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "primary key of orders": "SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1",
    "lineitem keys present": "SELECT 1 FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL",
    "lineitem refers to orders": "SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "lineitem refers to part": "SELECT 1 FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)",
    "orders refer to customer": "SELECT 1 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "ship year has a partition": "SELECT 1 FROM lineitem WHERE extract(year FROM l_shipdate) NOT BETWEEN 1996 AND 2000",
}


@query(
    "dq_constraints",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations, count(*) = 0 AS passed FROM ({sql})"
        for name, sql in _CONSTRAINTS.items()
    ),
)
def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders, part, customer = [
        views.table(spark, sf_dir, t) for t in ("lineitem", "orders", "part", "customer")
    ]
    shipped = line.select(F.to_date("l_shipdate").alias("ship_date"))
    results = [
        checks.duplicate_keys(line, "l_orderkey", "l_linenumber"),
        checks.duplicate_keys(orders, "o_orderkey"),
        checks.missing_keys(line, "l_orderkey", "l_linenumber"),
        checks.orphans(line, "l_orderkey", orders, "o_orderkey"),
        checks.orphans(line, "l_partkey", part, "p_partkey"),
        checks.orphans(orders, "o_custkey", customer, "c_custkey"),
        checks.outside_years(shipped, "ship_date", 1996, 2000),
    ]
    return checks.scorecard(dict(zip(_CONSTRAINTS, results, strict=True)))
