"""Silver to gold: the star schema.

Dimensions are joined without broadcast hints. Spark broadcasts a side when
its size is below the configured bound and else shuffles, with hot keys split
by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratoform.functions.codes import merged_gender
from stratoform.operators.keys import KeyRegistry
from stratoform.operators.numbering import with_row_numbers
from stratoform.operators.versions import with_version_in_force


@dataclass(frozen=True)
class GoldKeys:
    """Where the keys of the dimensions are kept from one load to the next."""

    path: str

    @property
    def customers(self) -> KeyRegistry:
        return KeyRegistry(f"{self.path}/customer_keys", ("customer_id",), "customer_key")

    @property
    def products(self) -> KeyRegistry:
        """Of product versions."""
        return KeyRegistry(f"{self.path}/product_keys", ("product_id",), "product_key")

    def assign(self, silver: Mapping[str, DataFrame]) -> dict[str, int]:
        """Gives keys to the members that have none yet, once for each load; how many were new."""
        customers = silver["crm_cust_info"].select(F.col("cst_id").alias("customer_id"))
        products = silver["crm_prd_info"].withColumn("product_id", F.col("prd_id"))
        return {
            "dim_customers": self.customers.assign(customers),
            "dim_products": self.products.assign(products, ["prd_start_dt", "prd_key"]),
        }


def dim_customers(
    customers: DataFrame, erp: DataFrame, locations: DataFrame, keys: KeyRegistry | None = None
) -> DataFrame:
    """Customers with birth date, merged gender and country.

    Their keys are those of the registry, or else their places by id, which
    other members may change.
    """
    joined = (
        customers.join(erp, customers["cst_key"] == erp["cid"], "left")
        .join(locations, customers["cst_key"] == locations["cid"], "left")
        .select(
            F.col("cst_id").alias("customer_id"),
            F.col("cst_key").alias("customer_number"),
            F.col("cst_firstname").alias("first_name"),
            F.col("cst_lastname").alias("last_name"),
            F.col("cntry").alias("country"),
            F.col("cst_marital_status").alias("marital_status"),
            merged_gender(F.col("cst_gndr"), F.col("gen")).alias("gender"),
            F.col("bdate").alias("birthdate"),
            F.col("cst_create_date").alias("create_date"),
        )
    )
    return keys.keyed(joined) if keys else with_row_numbers(joined, ["customer_id"], "customer_key")


def dim_products(products: DataFrame, categories: DataFrame, keys: KeyRegistry | None = None) -> DataFrame:
    """Product versions with their category; keys as for customers, else by start date and key."""
    joined = products.join(categories, products["cat_id"] == categories["id"], "left").select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category_name"),
        F.col("subcat").alias("subcategory_name"),
        F.col("maintenance").alias("maintenance_flag"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
        F.col("prd_end_dt").alias("end_date"),
    )
    if keys:
        return keys.keyed(joined)
    return with_row_numbers(joined, ["start_date", "product_number", "product_id"], "product_key")


_MEASURES = {
    "sls_order_dt": "order_date",
    "sls_ship_dt": "shipping_date",
    "sls_due_dt": "due_date",
    "sls_sales": "sales_amount",
    "sls_quantity": "quantity",
    "sls_price": "unit_price",
}


def _fact_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        *[F.col(c).alias(name) for c, name in _MEASURES.items()],
    )


def _customer_keys(dim: DataFrame) -> DataFrame:
    return dim.select("customer_id", "customer_key")


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales joined to every version of their product, as the source model has it.

    A product with three versions gives three rows per sale; use
    ``fact_sales_as_of`` for one.
    """
    versions = products.select("product_number", "product_key")
    buyers = _customer_keys(customers)
    return _fact_columns(
        sales.join(versions, sales["sls_prd_key"] == versions["product_number"], "left").join(
            buyers, sales["sls_cust_id"] == buyers["customer_id"], "left"
        )
    )


def fact_sales_as_of(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with the product version valid on the order date; one row per sale."""
    versions = products.withColumnRenamed("product_number", "sls_prd_key")
    placed = with_version_in_force(
        sales, versions, "sls_prd_key", "sls_order_dt", "start_date", ["product_id"], ["product_key"], "end_date"
    )
    buyers = _customer_keys(customers)
    return _fact_columns(placed.join(buyers, placed["sls_cust_id"] == buyers["customer_id"], "left"))


def build_dimensions(silver: Mapping[str, DataFrame], keys: GoldKeys | None = None) -> dict[str, DataFrame]:
    return {
        "dim_customers": dim_customers(
            silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"], keys and keys.customers
        ),
        "dim_products": dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"], keys and keys.products),
    }


def build_gold(silver: Mapping[str, DataFrame], keys: GoldKeys | None = None) -> dict[str, DataFrame]:
    """The star; with ``keys``, whose members ``GoldKeys.assign`` has seen, old facts stay right."""
    customers, products = build_dimensions(silver, keys).values()
    return {
        "dim_customers": customers,
        "dim_products": products,
        "fact_sales": fact_sales(silver["crm_sales_details"], products, customers),
    }


def save_as_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table from a plan."""
    df.write.mode("overwrite").saveAsTable(name)
