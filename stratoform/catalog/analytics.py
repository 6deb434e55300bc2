"""Analytical queries on the sales star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.registry import REGIONS, SINCE, query
from stratoform.catalog.sql import mean, with_tables
from stratoform.model import views
from stratoform.plans import sales as plans
from stratoform.session import stage


def recent_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.since(views.sales(spark, sf_dir), SINCE)


def recent_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.totals_by_customer(recent_sales(spark, sf_dir), views.buyers(spark, sf_dir))


DAILY = with_tables(
    f"""SELECT sale_date, count(*) AS total_sales, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
               {mean("sum(net_amount)", "count(*)")} AS avg_sale_amount
        FROM recent GROUP BY sale_date""",
    "recent",
)


@query("daily_sales_aggregation", DAILY)
def daily_sales_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_sales(recent_sales(spark, sf_dir))


@query(
    "customer_analysis",
    with_tables(
        f"""SELECT region, count(DISTINCT c.customer_id) AS unique_customers, count(sale_id) AS total_sales,
                   CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
                   {mean("sum(net_amount)", "count(sale_id)")} AS avg_purchase
            FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
            WHERE sale_date >= DATE '1998-01-01' GROUP BY region""",
        "customers",
        "sales",
    ),
)
def customer_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.customer_analysis(recent_by_customer(spark, sf_dir), views.dim_customers(spark, sf_dir))


@query(
    "product_performance",
    with_tables(
        f"""SELECT category_name, count(sale_id) AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
                   CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
                   {mean("sum(unit_price)", "count(sale_id)")} AS avg_price
            FROM products p LEFT JOIN sales s ON p.product_id = s.product_id
            WHERE sale_date >= DATE '1998-01-01' GROUP BY category_name""",
        "products",
        "sales",
    ),
)
def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_product = plans.totals(recent_sales(spark, sf_dir), "product_id")
    return plans.product_performance(by_product, views.dim_products(spark, sf_dir))


@query(
    "top_customers",
    with_tables(
        """SELECT customer_name, region, count(sale_id) AS purchase_count,
                  CAST(sum(net_amount) AS DOUBLE) AS total_spent
           FROM customers c JOIN recent s ON c.customer_id = s.customer_id
           GROUP BY c.customer_id, customer_name, region HAVING count(sale_id) > 5
           ORDER BY sum(net_amount) DESC, c.customer_id LIMIT 10""",
        "customers",
        "recent",
    ),
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_customers(recent_by_customer(spark, sf_dir), views.dim_customers(spark, sf_dir))


@query(
    "monthly_trends",
    with_tables(
        f"""SELECT CAST(extract(year FROM sale_date) AS BIGINT) AS year,
                   CAST(extract(month FROM sale_date) AS BIGINT) AS month, count(*) AS sales_count,
                   CAST(sum(net_amount) AS DOUBLE) AS monthly_revenue,
                   {mean("sum(net_amount)", "count(*)")} AS avg_sale_amount
            FROM recent GROUP BY 1, 2""",
        "recent",
    ),
)
def monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.monthly_trends(recent_sales(spark, sf_dir))


DAILY_REGION = with_tables(
    f"""SELECT sale_date, region, count(*) AS total_sales, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
               {mean("sum(net_amount)", "count(*)")} AS avg_sale_amount
        FROM recent s JOIN customers c ON s.customer_id = c.customer_id
        WHERE region IN ('AMERICA', 'ASIA', 'EUROPE') GROUP BY sale_date, region""",
    "recent",
    "customers",
)


def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent sales of the customers of some regions, with the region."""
    wanted = plans.in_regions(views.dim_customers(spark, sf_dir), REGIONS)
    return views.located_sales(recent_sales(spark, sf_dir), views.buyers(spark, sf_dir), wanted, "region")


@query("daily_region_sales", DAILY_REGION)
def daily_region_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_by_region(regional_sales(spark, sf_dir))


@query(
    "customer_segmentation",
    with_tables(
        f"""SELECT region, gender, count(DISTINCT c.customer_id) AS unique_customers,
                   CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
                   {mean("sum(net_amount)", "count(sale_id)")} AS avg_purchase_amount
            FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
            WHERE sale_date >= DATE '1998-01-01' GROUP BY region, gender HAVING count(sale_id) > 0""",
        "customers",
        "sales",
    ),
)
def customer_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.customer_segmentation(recent_by_customer(spark, sf_dir), views.dim_customers(spark, sf_dir))


def target_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.dim_customers(spark, sf_dir)
    return customers.where(F.col("gender") == "AUTOMOBILE").select("customer_id")


def target_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dim_products(spark, sf_dir).where(F.col("category_id") == "Brand#5").select("product_id")


@query(
    "customer_product_pairs",
    with_tables(
        """SELECT DISTINCT customer_id, product_id FROM sales
           WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
             AND product_id IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#5')""",
        "sales",
    ),
)
def customer_product_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lines and headers are both cut to what is wanted before they are joined.
    lines = views.sales(spark, sf_dir).join(target_products(spark, sf_dir), "product_id", "left_semi")
    headers = plans.having_row(views.buyers(spark, sf_dir), target_customers(spark, sf_dir), "customer_id")
    return plans.distinct_pairs(lines.join(headers, "sale_id"))


def subsets() -> dict[str, Column]:
    return {
        "all": F.lit(True),
        "recent": F.col("sale_date") >= F.lit(SINCE),
        "high value": F.col("net_amount") > 100_000,
    }


_SUBSET_TESTS = {
    "all": "TRUE",
    "recent": "sale_date >= DATE '1998-01-01'",
    "high value": "net_amount > 100000",
}


def subsets_sql(measure: str) -> str:
    return with_tables(
        " UNION ALL ".join(
            f"SELECT '{name}' AS subset, {measure} FROM sales WHERE {test}"
            for name, test in _SUBSET_TESTS.items()
        ),
        "sales",
    )


@query("distinct_by_subset", subsets_sql("count(DISTINCT customer_id) AS customers"))
def distinct_by_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.distinct_customers(views.sales_with_customer(spark, sf_dir), subsets())


@query(
    "semi_prefilter",
    with_tables(
        """SELECT sale_id, line_number, customer_id, CAST(net_amount AS DOUBLE) AS net_amount FROM recent s
           WHERE EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = s.customer_id AND region = 'ASIA')""",
        "recent",
        "customers",
    ),
)
def semi_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    asia = plans.in_regions(views.dim_customers(spark, sf_dir), ["ASIA"])
    # The customer is known from the sale's header, so that is what is filtered.
    headers = plans.having_row(views.buyers(spark, sf_dir), asia, "customer_id")
    lines = recent_sales(spark, sf_dir).join(headers, "sale_id")
    return lines.select("sale_id", "line_number", "customer_id", "net_amount")


@query(
    "point_lookup_batch",
    with_tables(
        """SELECT p.customer_id, count(s.sale_id) > 0 AS found, count(s.sale_id) AS sale_count
           FROM (SELECT c_custkey AS customer_id FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
                 UNION SELECT -c_custkey - 1 FROM customer WHERE c_mktsegment = 'AUTOMOBILE') p
                LEFT JOIN sales s ON s.customer_id = p.customer_id
           GROUP BY p.customer_id""",
        "sales",
    ),
)
def point_lookup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers looked up by id; every second id is unknown."""
    known = target_customers(spark, sf_dir)
    # Stored, as several branches ask for them.
    probes = stage(known.unionByName(unknown_ids(known, "customer_id")), "probes")
    headers = plans.having_row(views.buyers(spark, sf_dir), probes, "customer_id")
    return plans.lookup(probes, "customer_id", views.totals_of_buyers(views.sales(spark, sf_dir), headers))


def unknown_ids(known: DataFrame, key: str) -> DataFrame:
    """As many ids that belong to nobody."""
    return known.select((-F.col(key) - 1).alias(key))
