"""Bronze to silver: one function per table.

``batch_time`` stamps every row of a run and is passed in, so that a repeated
run gives the same table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.functions import amounts, codes, dates, text
from stratoform.operators.latest import latest_per_key
from stratoform.operators.versions import with_next_start

_CHANGED = "src_update_at"


def _loaded_at(batch_time: dt.datetime) -> Column:
    return F.lit(batch_time).cast("timestamp").alias("dwh_create_date")


def clean_customers(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    """The latest record of each customer, with names trimmed and codes spelled out."""
    known = bronze.where(F.col("cst_id").isNotNull())
    newest = latest_per_key(known, ["cst_id"], ["cst_create_date", _CHANGED])
    return newest.select(
        F.col("cst_id").cast("bigint").alias("cst_id"),
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        codes.marital_status(F.col("cst_marital_status")).alias("cst_marital_status"),
        codes.crm_gender(F.col("cst_gndr")).alias("cst_gndr"),
        F.col("cst_create_date").cast("date").alias("cst_create_date"),
        _loaded_at(batch_time),
    )


def _cost() -> Column:
    return text.blank_to_null(F.col("prd_cost")).try_cast("decimal(10,2)")


def _cost_is_no_amount() -> Column:
    return text.blank_to_null(F.col("prd_cost")).isNotNull() & _cost().isNull()


def rejected_products(bronze: DataFrame) -> DataFrame:
    """The latest record of each product id whose cost is given but is no amount of the silver type."""
    return latest_per_key(bronze, ["prd_id"], [_CHANGED]).where(_cost_is_no_amount())


def clean_products(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    """One row per product id; a version ends the day before the next one of its key starts.

    A missing cost is 0. A record whose cost is no amount is left to
    ``rejected_products``; its version still ends the one before it.
    """
    versions = with_next_start(bronze, "prd_key", "prd_start_dt", ["prd_id", _CHANGED])
    newest = latest_per_key(versions, ["prd_id"], [_CHANGED]).where(~_cost_is_no_amount())
    raw_key = F.col("prd_key")
    cost = F.coalesce(_cost(), F.lit(0).cast("decimal(10,2)"))
    return newest.select(
        F.col("prd_id").cast("bigint").alias("prd_id"),
        text.category_of(raw_key).alias("cat_id"),
        text.product_of(raw_key).alias("prd_key"),
        "prd_nm",
        cost.alias("prd_cost"),
        codes.product_line(F.col("prd_line")).alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        dates.day_before(F.to_date("next_start")).alias("prd_end_dt"),
        _loaded_at(batch_time),
    )


def clean_sales(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    """Sales lines with real dates and consistent amounts; every line is kept."""
    measures = [F.col(c) for c in ("sls_sales", "sls_quantity", "sls_price")]
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        F.col("sls_cust_id").cast("bigint").alias("sls_cust_id"),
        *[dates.parse_int_date(F.col(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        amounts.repaired_sales(*measures).alias("sls_sales"),
        F.col("sls_quantity").cast("int").alias("sls_quantity"),
        amounts.repaired_price(*measures).alias("sls_price"),
        _loaded_at(batch_time),
    )


def clean_erp_customers(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    """Birth date and gender per customer number, without the system prefix."""
    cleaned = bronze.select(
        text.without_prefix(F.col("cid")).alias("cid"),
        dates.past_or_null(F.col("bdate").cast("date"), batch_time.date()).alias("bdate"),
        codes.erp_gender(F.col("gen")).alias("gen"),
        _CHANGED,
    )
    newest = latest_per_key(cleaned, ["cid"], [_CHANGED])
    return newest.select("cid", "bdate", "gen", _loaded_at(batch_time))


def clean_locations(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    """Country per customer number."""
    cleaned = bronze.select(
        text.without_dashes(F.col("cid")).alias("cid"), codes.country(F.col("cntry")).alias("cntry"), _CHANGED
    )
    newest = latest_per_key(cleaned, ["cid"], [_CHANGED])
    return newest.select("cid", "cntry", _loaded_at(batch_time))


def clean_categories(bronze: DataFrame, batch_time: dt.datetime) -> DataFrame:
    newest = latest_per_key(bronze, ["id"], [_CHANGED])
    return newest.select("id", "cat", "subcat", "maintenance", _loaded_at(batch_time))


# Table names, as in the schemas.
TRANSFORMS = {
    "crm_cust_info": clean_customers,
    "crm_prd_info": clean_products,
    "crm_sales_details": clean_sales,
    "erp_cust_az12": clean_erp_customers,
    "erp_loc_a101": clean_locations,
    "erp_px_cat_g1v2": clean_categories,
}


#: Records that a transform sets aside, by table.
REJECTS = {"crm_prd_info": rejected_products}


def build_silver(bronze: dict[str, DataFrame], batch_time: dt.datetime) -> dict[str, DataFrame]:
    return {name: TRANSFORMS[name](df, batch_time) for name, df in bronze.items()}
