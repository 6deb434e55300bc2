"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.registry import BATCH_TIME, query
from stratoform.catalog.sql import parsed, with_tables
from stratoform.functions import amounts, dates
from stratoform.model import views
from stratoform.plans.silver import REJECTS, TRANSFORMS


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return TRANSFORMS[name](views.BRONZE[name](spark, sf_dir), BATCH_TIME)


def _register(name: str, table: str, sql: str, fragment: str) -> None:
    @query(name, with_tables(sql, fragment))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The audit column holds the time of the run and is no result.
        return silver(spark, sf_dir, table).drop("dwh_create_date")


_register("clean_customers", "crm_cust_info", "SELECT * FROM silver_customers", "silver_customers")
_register(
    "clean_products",
    "crm_prd_info",
    "SELECT * REPLACE (CAST(prd_cost AS DOUBLE) AS prd_cost) FROM silver_products",
    "silver_products",
)


@query(
    "rejected_products",
    with_tables("SELECT prd_id, prd_key, '12x' AS prd_cost FROM raw_products WHERE bad_cost", "raw_products"),
)
def rejected_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REJECTS["crm_prd_info"](views.raw_products(spark, sf_dir)).select("prd_id", "prd_key", "prd_cost")


_register("clean_sales", "crm_sales_details", "SELECT * FROM silver_sales", "silver_sales")
_register("clean_erp_customers", "erp_cust_az12", "SELECT * FROM silver_erp", "silver_erp")
_register("clean_locations", "erp_loc_a101", "SELECT * FROM silver_locations", "silver_locations")
_register("clean_categories", "erp_px_cat_g1v2", "SELECT * FROM silver_categories", "silver_categories")


@query(
    "clean_int_dates",
    with_tables(
        f"""SELECT sls_order_dt AS raw_date, {parsed("sls_order_dt")} AS clean_date, count(*) AS records
            FROM raw_sales GROUP BY 1, 2""",
        "raw_sales",
    ),
)
def clean_int_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_sales(spark, sf_dir).groupBy(F.col("sls_order_dt").alias("raw_date"))
    counted = raw.agg(F.count(F.lit(1)).alias("records"))
    return counted.withColumn("clean_date", dates.parse_int_date(F.col("raw_date")))


@query(
    "repair_sales",
    with_tables(
        """SELECT r.sls_ord_num, r.sls_sales AS raw_sales, r.sls_quantity, r.sls_price AS raw_price,
                  CASE WHEN r.sls_sales IS NULL OR r.sls_sales <= 0 OR r.sls_sales <> r.sls_quantity * abs(r.sls_price)
                       THEN r.sls_quantity * abs(r.sls_price) ELSE r.sls_sales END AS sls_sales,
                  CASE WHEN r.sls_price IS NULL OR r.sls_price <= 0
                       THEN CAST(trunc(r.sls_sales / CASE WHEN r.sls_quantity = 0 THEN 1 ELSE r.sls_quantity END) AS INTEGER)
                       ELSE r.sls_price END AS sls_price
           FROM raw_sales r""",
        "raw_sales",
    ),
)
def repair_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [F.col(c) for c in ("sls_sales", "sls_quantity", "sls_price")]
    return views.raw_sales(spark, sf_dir).select(
        "sls_ord_num",
        F.col("sls_sales").alias("raw_sales"),
        "sls_quantity",
        F.col("sls_price").alias("raw_price"),
        amounts.repaired_sales(*measures).alias("sls_sales"),
        amounts.repaired_price(*measures).alias("sls_price"),
    )
