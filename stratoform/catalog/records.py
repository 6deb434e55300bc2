"""Job records, declared tables, inline rows and stamps of a run."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.cleansing import silver
from stratoform.catalog.modelling import gold_products
from stratoform.catalog.registry import BATCH_TIME, query
from stratoform.catalog.sql import with_tables
from stratoform.model import views
from stratoform.model.schemas import DeclaredTable
from stratoform.plans.gold import save_as_table
from stratoform.session import scratch_path
from stratoform.sources.generate import rows_to_table
from stratoform.sources.jobs import JobConfig, JobRun, JobStore, config_records, log_records

_LOADED = ("customer", "events", "lineitem", "orders", "part")
_DATED = ("events", "lineitem", "orders")
_LONG = "a very long reason " * 30


def _database(spark: SparkSession) -> str:
    """A database of the query's own, below the scratch folder."""
    name = f"queries_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


@query(
    "job_log",
    " UNION ALL ".join(
        f"""SELECT 'extract_{t}_to_bronze.{t}' AS job_name, DATE '2025-01-01' AS run_date, 60 * {i} AS seconds,
                   count(*) AS record_count, CASE WHEN count(*) > 1000 THEN 'success' ELSE 'failed' END AS status,
                   CASE WHEN count(*) <= 1000 THEN {len(_LONG)} END AS message_length, TRUE AS has_id,
                   {len(_LOADED)} AS ids FROM {t}"""
        for i, t in enumerate(_LOADED)
    ),
)
def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line for each table, appended one by one; ids are new, and long texts are kept whole."""
    store = JobStore(scratch_path(spark, "jobs"))
    for i, table in enumerate(_LOADED):
        count = views.table(spark, sf_dir, table).count()
        ended = BATCH_TIME + dt.timedelta(minutes=i)
        good = count > 1000
        run = JobRun(
            f"extract_{table}_to_bronze.{table}", BATCH_TIME, ended, count, "success" if good else "failed", None if good else _LONG
        )
        store.append(log_records(spark, [run], ended), "job_log")
    log = spark.read.parquet(f"{store.path}/job_log")
    ids = log.agg(F.count_distinct("log_id").cast("int").alias("ids")).scalar()
    return log.select(
        "job_name",
        "run_date",
        (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).cast("int").alias("seconds"),
        "record_count",
        "status",
        F.length("error_message").alias("message_length"),
        F.col("log_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("has_id"),
        ids.alias("ids"),
    )


@query(
    "job_config",
    " UNION ALL ".join(
        f"""SELECT 'extract_{t}_to_bronze.{t}' AS job_name, '{t}' AS source_table, {int(t in _DATED)} AS load_type,
                   'manual' AS schedule_type, CAST(count(*) > 0 AS INTEGER) AS is_active FROM {t}"""
        for t in _LOADED
    ),
)
def job_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration for each table: dated ones by increment, empty ones inactive."""
    configs = [
        JobConfig(
            f"extract_{t}_to_bronze.{t}",
            "public",
            t,
            "bronze",
            t,
            "increment" if t in _DATED else "full",
            is_active=int(not views.table(spark, sf_dir, t).isEmpty()),
        )
        for t in _LOADED
    ]
    store = JobStore(scratch_path(spark, "jobs"))
    store.append(config_records(spark, configs, BATCH_TIME), "job_config")
    config = spark.read.parquet(f"{store.path}/job_config")
    return config.select("job_name", "source_table", "load_type", "schedule_type", "is_active")


@query(
    "declared_table",
    with_tables(
        """SELECT 'layer' AS property, 'silver' AS value UNION ALL SELECT 'source_system', 'crm'
           UNION ALL SELECT 'source_table', 'crm_prd_info'
           UNION ALL SELECT 'records', CAST(count(*) AS VARCHAR) FROM silver_products""",
        "silver_products",
    ),
)
def declared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties and rows of a declared table that was loaded twice."""
    declared = DeclaredTable("silver", "crm_prd_info", _database(spark))
    for _ in range(2):
        declared.replace(silver(spark, sf_dir, "crm_prd_info"))
    shown = spark.sql(f"SHOW TBLPROPERTIES {declared.full_name}").where(F.col("key").isin(*declared.properties))
    shown = shown.select(F.col("key").alias("property"), F.lower("value").alias("value"))
    count = spark.table(declared.full_name).agg(F.count(F.lit(1)).cast("string").alias("value"))
    return shown.unionByName(count.withColumn("property", F.lit("records")))


@query("create_table_as", with_tables("SELECT * FROM gold_products", "gold_products"))
def create_table_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table made from a plan, replaced once."""
    name = f"{_database(spark)}.dim_products"
    products = gold_products(spark, sf_dir)
    for rows in (products.limit(1), products):
        save_as_table(rows, name)
    return spark.table(name)


_CATEGORIES = (
    {"category_id": "Brand#1", "category_name": "first", "description": "it's \"quoted\""},
    {"category_id": "Brand#2", "category_name": "second", "parent_category_id": "Brand#1"},
    {"category_id": "none", "category_name": "never sold"},
)


@query(
    "inline_rows",
    """SELECT c.*, (SELECT count(*) FROM part WHERE p_brand = category_id) AS products
       FROM (VALUES ('Brand#1', 'first', NULL, 'it''s "quoted"'), ('Brand#2', 'second', 'Brand#1', NULL),
                    ('none', 'never sold', NULL, NULL)) c (category_id, category_name, parent_category_id, description)""",
)
def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows of a dimension with the number of products of each."""
    categories = rows_to_table(spark, "dim_categories", _CATEGORIES).drop("created_at")
    counts = views.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("category_id"))
    joined = categories.join(counts.agg(F.count(F.lit(1)).alias("products")), "category_id", "left")
    return joined.withColumn("products", F.coalesce("products", F.lit(0).cast("bigint")))


@query(
    "batch_stamp",
    with_tables("SELECT cst_id, TIMESTAMP '2025-01-01' AS dwh_create_date FROM silver_customers", "silver_customers"),
)
def batch_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a run has the run's time, whenever it is computed."""
    return silver(spark, sf_dir, "crm_cust_info").select("cst_id", "dwh_create_date")
