"""Scalar expressions over whole columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.registry import query
from stratoform.catalog.sql import hash1, parsed, with_tables
from stratoform.functions import amounts, codes, dates, hashing, text
from stratoform.model import views


@query(
    "scalar_strings",
    """SELECT o_orderkey, trim('  ' || o_orderpriority || ' ') AS trimmed,
              upper(trim(' ' || lower(o_orderpriority))) AS normalised,
              length(CAST(o_orderkey AS VARCHAR)) AS key_length, substr(o_orderpriority, 3, 4) AS part,
              replace(o_orderpriority, '-', '_') AS underscored, replace(o_orderpriority, '-', '') AS undashed,
              'SALE' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS padded,
              o_custkey || '_' || o_orderkey AS composite,
              substr(repeat(o_orderpriority, 60), 1, 255) AS log_text
       FROM orders""",
)
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey")
    return views.table(spark, sf_dir, "orders").select(
        key,
        F.trim(F.concat(F.lit("  "), priority, F.lit(" "))).alias("trimmed"),
        codes.normalised(F.concat(F.lit(" "), F.lower(priority))).alias("normalised"),
        F.length(key.cast("string")).cast("bigint").alias("key_length"),
        F.substring(priority, 3, 4).alias("part"),
        F.regexp_replace(priority, "-", "_").alias("underscored"),
        text.without_dashes(priority).alias("undashed"),
        text.padded_key("SALE", key, 6).alias("padded"),
        text.composite(F.col("o_custkey"), key).alias("composite"),
        text.log_text(F.repeat(priority, 60)).alias("log_text"),
    )


@query(
    "scalar_dates",
    f"""SELECT event_id, {parsed("CAST(strftime(ts, '%Y%m%d') AS INTEGER)")} AS parsed,
               CAST(ts AS DATE) - 1 AS day_before, CAST(ts AS DATE) + CAST(event_id % 365 AS INTEGER) AS days_after,
               CAST(extract(year FROM ts) AS BIGINT) AS year, CAST(extract(month FROM ts) AS BIGINT) AS month,
               CAST(round(epoch(ts + to_seconds(event_id % 5000)) - epoch(ts)) AS INTEGER) AS elapsed,
               strftime(ts, '%Y-%m-%d') AS day_text
        FROM events""",
)
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, day = F.col("ts"), F.to_date("ts")
    later = (ts + F.make_dt_interval(secs=F.col("event_id") % 5000)).cast("timestamp")
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        dates.parse_int_date(F.date_format(ts, "yyyyMMdd").cast("int")).alias("parsed"),
        dates.day_before(day).alias("day_before"),
        F.date_add(day, (F.col("event_id") % 365).cast("int")).alias("days_after"),
        F.year(ts).cast("bigint").alias("year"),
        F.month(ts).cast("bigint").alias("month"),
        dates.whole_seconds(ts.cast("timestamp"), later).alias("elapsed"),
        F.date_format(day, "yyyy-MM-dd").alias("day_text"),
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, abs(-l_linenumber) AS magnitude,
              CAST(trunc(CAST(-l_orderkey AS DOUBLE) / l_linenumber) AS INTEGER) AS truncated,
              CAST(trunc(CAST(l_orderkey AS DOUBLE) /
                   CASE WHEN l_linenumber - 1 = 0 THEN 1 ELSE l_linenumber - 1 END) AS INTEGER) AS guarded,
              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net,
              round(l_extendedprice, 0) AS rounded
       FROM lineitem""",
)
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    before = line - 1
    key = F.col("l_orderkey").cast("double")
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(-line).alias("magnitude"),
        (-key / line).cast("int").alias("truncated"),
        (key / F.when(before != 0, before).otherwise(1)).cast("int").alias("guarded"),
        amounts.net_amount(F.col("l_extendedprice"), F.col("l_discount")).alias("net"),
        F.round("l_extendedprice", 0).alias("rounded"),
    )


@query(
    "scalar_null",
    """SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE o_orderpriority END), '') AS filled,
              coalesce(nullif(o_orderstatus, 'O'), 'open') AS status, nullif(o_orderkey % 5, 0) AS remainder,
              CAST(coalesce(TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'none'
                       ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS DECIMAL(12,2)), 0) AS DOUBLE) AS price
       FROM orders""",
)
def scalar_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    price = amounts.money(F.col("o_totalprice")).cast("string")
    return views.table(spark, sf_dir, "orders").select(
        key,
        text.blank_to_null(F.when(key % 7 == 0, " ").otherwise(F.col("o_orderpriority"))).alias("filled"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("open")).alias("status"),
        F.nullif(key % 5, F.lit(0).cast("bigint")).alias("remainder"),
        F.coalesce(
            F.when(key % 11 == 0, "none").otherwise(price).try_cast("decimal(12,2)"),
            F.lit(0).cast("decimal(12,2)"),
        ).alias("price"),
    )


@query(
    "hash_buckets",
    f"""SELECT {hash1("CAST(o_custkey AS VARCHAR)")} % 64 AS bucket, count(*) AS records,
               count(DISTINCT o_custkey) AS customers
        FROM orders GROUP BY 1""",
)
def hash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = hashing.bucket(F.col("o_custkey"), 64, hashing.Hash.PORTABLE)
    return (
        views.table(spark, sf_dir, "orders")
        .groupBy(at.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("o_custkey").alias("customers"))
    )


def _count_labels(df: DataFrame, code: str, label: Column) -> DataFrame:
    return df.groupBy(F.col(code).alias("code"), label.alias("label")).agg(F.count(F.lit(1)).alias("records"))


@query(
    "code_map_marital",
    with_tables(
        """SELECT cst_marital_status AS code,
                  CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END AS label,
                  count(*) AS records FROM raw_customers GROUP BY 1, 2""",
        "raw_customers",
    ),
)
def code_map_marital(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_customers(spark, sf_dir)
    return _count_labels(raw, "cst_marital_status", codes.marital_status(F.col("cst_marital_status")))


@query(
    "code_map_gender",
    with_tables(
        """SELECT gen AS code, CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                  WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS label,
                  count(*) AS records FROM raw_erp GROUP BY 1, 2""",
        "raw_erp",
    ),
)
def code_map_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_labels(views.raw_erp_customers(spark, sf_dir), "gen", codes.erp_gender(F.col("gen")))


@query(
    "code_map_line",
    with_tables(
        """SELECT prd_line AS code,
                  CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                       WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS label,
                  count(*) AS records FROM raw_products GROUP BY 1, 2""",
        "raw_products",
    ),
)
def code_map_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_labels(views.raw_products(spark, sf_dir), "prd_line", codes.product_line(F.col("prd_line")))


@query(
    "code_map_country",
    with_tables(
        """SELECT cntry AS code,
                  CASE WHEN trim(cntry) = 'DE' THEN 'Germany' WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                       WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a' ELSE trim(cntry) END AS label,
                  count(*) AS records FROM raw_locations GROUP BY 1, 2""",
        "raw_locations",
    ),
)
def code_map_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_labels(views.raw_locations(spark, sf_dir), "cntry", codes.country(F.col("cntry")))


@query(
    "strip_prefix",
    with_tables(
        """SELECT cid, CASE WHEN cid LIKE 'NAS%' THEN substr(cid, 4) ELSE cid END AS stripped, count(*) AS records
           FROM raw_erp GROUP BY 1, 2""",
        "raw_erp",
    ),
)
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = text.without_prefix(F.col("cid")).alias("stripped")
    return views.raw_erp_customers(spark, sf_dir).groupBy("cid", stripped).agg(F.count(F.lit(1)).alias("records"))
