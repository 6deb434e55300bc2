"""From source rows to gold tables, twice."""

from __future__ import annotations

import datetime as dt

from stratoform.model import views
from stratoform.model.schemas import GOLD, SILVER, schema_of
from stratoform.plans.layers import refresh
from stratoform.plans.quality import duplicate_keys, orphans, scorecard, untrimmed
from stratoform.sources.changes import KeyedTable
from stratoform.sources.files import FrameSource
from stratoform.sources.load import TableLoad, load_all

# Key and order of the newest row, per bronze table.
KEYS = {
    "crm_cust_info": (),
    "crm_prd_info": ("prd_id",),
    "crm_sales_details": (),
    "erp_loc_a101": (),
    "erp_cust_az12": (),
    "erp_px_cat_g1v2": (),
}


def test_refresh(spark, sf_dir, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_bronze")
    sources = views.bronze(spark, sf_dir)
    targets = {
        name: KeyedTable(f"file://{tmp_path}/{name}", keys, ("src_update_at",))
        for name, keys in KEYS.items()
    }
    loads = [TableLoad(n, FrameSource(df), targets[n], "src_update_at") for n, df in sources.items()]
    outcome = load_all(spark, loads)
    assert outcome.where("status = 'success' and load_mode = 'full'").count() == 6
    counts = {name: target.read(spark).count() for name, target in targets.items()}
    assert load_all(spark, loads).where("load_mode = 'increment' and status = 'success'").count() == 6
    assert counts == {name: target.read(spark).count() for name, target in targets.items()}
    for name, target in targets.items():
        target.publish(spark, f"lake_bronze.{name}")
        assert spark.table(f"lake_bronze.{name}").columns == target.read(spark).columns

    batch = dt.datetime(2025, 1, 1)
    first = refresh(spark, batch, "lake_bronze", "lake_silver", "lake_gold").collect()
    for layer, database in ((SILVER, "lake_silver"), (GOLD, "lake_gold")):
        for name in layer:
            stored = spark.table(f"{database}.{name}").schema.simpleString()
            assert stored == schema_of(database.removeprefix("lake_"), name).simpleString()
    gold = {n: spark.table(f"lake_gold.{n}") for n in GOLD}
    card = scorecard(
        {
            "customer keys": duplicate_keys(gold["dim_customers"], "customer_key"),
            "product keys": duplicate_keys(gold["dim_products"], "product_key"),
            "customers": orphans(gold["fact_sales"], "customer_key", gold["dim_customers"], "customer_key"),
            "spaces": untrimmed(spark.table("lake_silver.crm_cust_info"), "cst_key"),
        }
    )
    assert card.where("not passed").count() == 0

    before = sorted(map(tuple, gold["dim_customers"].collect()))
    assert refresh(spark, batch, "lake_bronze", "lake_silver", "lake_gold").collect() == first
    assert sorted(map(tuple, spark.table("lake_gold.dim_customers").collect())) == before
