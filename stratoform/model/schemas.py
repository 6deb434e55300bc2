"""Declared schemas of every layer.

Fixed values: table and column names and types are the warehouse's data
contract; a user's existing tables have exactly these columns. Ids and surrogate
keys are bigint, as a large table outgrows the int of the sources; an int column
is widened on the way in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SOURCE_SYSTEM = {"crm": "crm", "erp": "erp"}

BRONZE = {
    "crm_cust_info": """
        cst_id bigint, cst_key string, cst_firstname string, cst_lastname string,
        cst_marital_status string, cst_gndr string, cst_create_date date,
        src_update_at timestamp""",
    "crm_prd_info": """
        prd_id bigint, prd_key string, prd_nm string, prd_cost string, prd_line string,
        prd_start_dt timestamp, prd_end_dt timestamp, src_update_at timestamp""",
    "crm_sales_details": """
        sls_ord_num string, sls_prd_key string, sls_cust_id bigint,
        sls_order_dt int, sls_ship_dt int, sls_due_dt int,
        sls_sales int, sls_quantity int, sls_price int, src_update_at timestamp""",
    "erp_loc_a101": "cid string, cntry string, src_update_at timestamp",
    "erp_cust_az12": "cid string, bdate date, gen string, src_update_at timestamp",
    "erp_px_cat_g1v2": "id string, cat string, subcat string, maintenance string, src_update_at timestamp",
}

SILVER = {
    "crm_cust_info": """
        cst_id bigint, cst_key string, cst_firstname string, cst_lastname string,
        cst_marital_status string, cst_gndr string, cst_create_date date,
        dwh_create_date timestamp""",
    "crm_prd_info": """
        prd_id bigint, cat_id string, prd_key string, prd_nm string, prd_cost decimal(10,2),
        prd_line string, prd_start_dt date, prd_end_dt date, dwh_create_date timestamp""",
    "crm_sales_details": """
        sls_ord_num string, sls_prd_key string, sls_cust_id bigint,
        sls_order_dt date, sls_ship_dt date, sls_due_dt date,
        sls_sales int, sls_quantity int, sls_price int, dwh_create_date timestamp""",
    "erp_loc_a101": "cid string, cntry string, dwh_create_date timestamp",
    "erp_cust_az12": "cid string, bdate date, gen string, dwh_create_date timestamp",
    "erp_px_cat_g1v2": "id string, cat string, subcat string, maintenance string, dwh_create_date timestamp",
}

GOLD = {
    "dim_customers": """
        customer_key bigint, customer_id bigint, customer_number string, first_name string,
        last_name string, country string, marital_status string, gender string,
        birthdate date, create_date date""",
    "dim_products": """
        product_key bigint, product_id bigint, product_number string, product_name string,
        category_id string, category_name string, subcategory_name string,
        maintenance_flag string, cost decimal(10,2), product_line string,
        start_date date, end_date date""",
    "fact_sales": """
        order_number string, product_key bigint, customer_key bigint, order_date date,
        shipping_date date, due_date date, sales_amount int, quantity int, unit_price int""",
}

SALES_STAR = {
    "dim_customers": """
        customer_id string, customer_name string, birth_date date, gender string, email string,
        phone string, address string, city string, region string,
        created_at timestamp, updated_at timestamp""",
    "dim_products": """
        product_id string, product_name string, category_id string, category_name string,
        unit_price decimal(10,2), cost decimal(10,2), description string,
        created_at timestamp, updated_at timestamp""",
    "dim_locations": """
        location_id string, location_name string, city string, region string, country string,
        created_at timestamp""",
    "dim_categories": """
        category_id string, category_name string, parent_category_id string, description string,
        created_at timestamp""",
    "fact_sales": """
        sale_id string, customer_id string, product_id string, location_id string, sale_date date,
        quantity int, unit_price decimal(10,2), total_amount decimal(12,2),
        discount_amount decimal(10,2), net_amount decimal(12,2), created_at timestamp""",
}

JOBS = {
    "job_config": """
        config_id string, job_name string, source_schema string, source_table string,
        source_db_type string, source_ip string, destination_schema string,
        destination_table string, destination_db_type string, destination_ip string,
        load_type int, schedule_type string, is_active int, created_date timestamp""",
    "job_log": """
        log_id string, job_name string, run_date date, start_time timestamp, end_time timestamp,
        record_count bigint, status string, error_message string, created_date timestamp""",
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD, "star": SALES_STAR, "jobs": JOBS}


def schema_of(layer: str, table: str) -> StructType:
    return StructType.fromDDL(LAYERS[layer][table])


@dataclass(frozen=True)
class DeclaredTable:
    """A catalog table with a declared schema, Parquet storage and properties."""

    layer: str
    table: str
    database: str | None = None

    @property
    def full_name(self) -> str:
        return f"{self.database or self.layer}.{self.table}"

    @property
    def properties(self) -> dict[str, str]:
        props = {"layer": self.layer, "source_table": self.table}
        system = SOURCE_SYSTEM.get(self.table.split("_")[0])
        if system:
            props["source_system"] = system
        return props

    def create(self, spark: SparkSession, location: str | None = None) -> None:
        """Create the database and the empty table unless they exist."""
        database, _, _ = self.full_name.partition(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(self.layer, self.table).fields
        )
        props = ", ".join(f"'{k}'='{v}'" for k, v in self.properties.items())
        where = f"LOCATION '{location}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.full_name} ({columns}) "
            f"USING PARQUET OPTIONS (compression 'snappy') {where} TBLPROPERTIES ({props})"
        )

    def replace(self, df: DataFrame) -> None:
        """These rows and no others; the table keeps its declaration and properties."""
        self.create(df.sparkSession)
        self.conform(df).write.insertInto(self.full_name, overwrite=True)

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` in the declared column order and types; fails on a lossy cast."""
        return df.to(schema_of(self.layer, self.table))
