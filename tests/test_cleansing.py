"""The cleansing rules on small invented rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratoform.functions import amounts, codes, dates, text
from stratoform.model.schemas import schema_of
from stratoform.plans import gold, silver

NOW = dt.datetime(2025, 1, 1, 6)
D = dt.date
T = dt.datetime


def bronze(spark, table, rows):
    return spark.createDataFrame(rows, schema_of("bronze", table))


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_customers(spark):
    raw = bronze(
        spark,
        "crm_cust_info",
        [
            (1, "AW1", " Ann ", "Lee", " s", "f", D(2024, 1, 1), T(2024, 1, 1)),
            (1, "AW1", "Ann", " Lee ", "M", "F ", D(2024, 2, 1), T(2024, 2, 1)),
            (2, "AW2", "Bo", None, None, "x", D(2024, 1, 5), T(2024, 1, 5)),
            (None, "AW3", "No", "Id", "S", "M", D(2024, 1, 1), T(2024, 1, 1)),
        ],
    )
    clean = silver.clean_customers(raw, NOW)
    assert clean.schema.names == schema_of("silver", "crm_cust_info").names
    assert values(clean, "cst_id", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr") == [
        (1, "Ann", "Lee", "Married", "Female"),
        (2, "Bo", None, "n/a", "n/a"),
    ]
    assert {r[0] for r in clean.select("dwh_create_date").collect()} == {NOW}


def test_customer_tie_goes_to_the_last_change(spark):
    rows = [
        (1, "AW1", "Old", "Lee", "S", "F", D(2024, 1, 1), T(2024, 1, 1)),
        (1, "AW1", "New", "Lee", "S", "F", D(2024, 1, 1), T(2024, 1, 2)),
    ]
    for order in (rows, rows[::-1]):
        clean = silver.clean_customers(bronze(spark, "crm_cust_info", order), NOW)
        assert values(clean, "cst_firstname") == [("New",)]


def test_products(spark):
    raw = bronze(
        spark,
        "crm_prd_info",
        [
            (1, "AC-HE-ZZ-1", "a", "12", "S ", T(2011, 7, 1), T(2007, 12, 28), T(2024, 1, 1)),
            (2, "AC-HE-ZZ-1", "b", None, "r", T(2012, 7, 1), None, T(2024, 1, 1)),
            (3, "ABC-12", "c", "5", None, T(2013, 1, 1), None, T(2024, 1, 1)),
            (3, "ABC-12", "c", "oops", None, T(2013, 1, 1), None, T(2023, 1, 1)),
        ],
    )
    clean = silver.clean_products(raw, NOW)
    got = values(clean.withColumn("prd_cost", F.col("prd_cost").cast("double")), "prd_id", "cat_id", "prd_key",
                 "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt")
    assert got == [
        (1, "AC_HE", "ZZ-1", 12.0, "Other Sales", D(2011, 7, 1), D(2012, 6, 30)),
        (2, "AC_HE", "ZZ-1", 0.0, "Road", D(2012, 7, 1), None),
        (3, "ABC_1", "ABC-12", 5.0, "n/a", D(2013, 1, 1), None),
    ]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ((100, 2, 50), (100, 2, 50)),
        ((None, 2, 50), (100, 2, 50)),
        ((-5, 2, 50), (100, 2, 50)),
        ((90, 2, 50), (100, 2, 50)),
        ((100, 2, None), (100, 2, 50)),
        ((100, 2, -50), (100, 2, 50)),
        ((None, 2, None), (None, 2, None)),
        ((0, 2, 0), (0, 2, 0)),
        ((35, 0, None), (35, 0, 35)),
        ((7, 2, None), (7, 2, 3)),
        ((-7, 2, None), (None, 2, -3)),
        ((90, 2, -50), (100, 2, 45)),
    ],
)
def test_sales_repair(spark, given, expected):
    raw = bronze(spark, "crm_sales_details", [("SO1", "P", 1, 20130105, 0, None, *given, T(2024, 1, 1))])
    row = silver.clean_sales(raw, NOW).first()
    assert (row["sls_sales"], row["sls_quantity"], row["sls_price"]) == expected
    assert (row["sls_order_dt"], row["sls_ship_dt"], row["sls_due_dt"]) == (D(2013, 1, 5), None, None)


def test_sales_keep_equal_lines(spark):
    line = ("SO1", "P", 1, 20130105, 20130105, 20130105, 1, 1, 1, T(2024, 1, 1))
    assert silver.clean_sales(bronze(spark, "crm_sales_details", [line, line]), NOW).count() == 2


@pytest.mark.parametrize(
    ("number", "expected"),
    [
        (None, None),
        (0, None),
        (2013010, None),
        (20130105, D(2013, 1, 5)),
        (20131340, None),
        (20130230, None),
        (-2013010, None),
        (201301051, None),
    ],
)
def test_int_dates(spark, number, expected):
    df = spark.createDataFrame([(number,)], "n int")
    assert df.select(dates.parse_int_date(F.col("n"))).first()[0] == expected


def test_erp_customers(spark):
    raw = bronze(
        spark,
        "erp_cust_az12",
        [
            ("NASAW001", D(1980, 5, 1), "female ", T(2024, 1, 1)),
            ("AW002", D(2999, 1, 1), "M", T(2024, 1, 1)),
            ("AW003", None, None, T(2024, 1, 1)),
            ("AW001", D(1970, 1, 1), "M", T(2023, 1, 1)),
        ],
    )
    assert values(silver.clean_erp_customers(raw, NOW), "cid", "bdate", "gen") == [
        ("AW001", D(1980, 5, 1), "Female"),
        ("AW002", None, "Male"),
        ("AW003", None, "n/a"),
    ]


def test_locations(spark):
    countries = [" DE ", "USA ", "us", "  ", None, " France", "US"]
    raw = bronze(spark, "erp_loc_a101", [(f"AW-{i}", c, T(2024, 1, 1)) for i, c in enumerate(countries)])
    assert values(silver.clean_locations(raw, NOW), "cid", "cntry") == [
        ("AW0", "Germany"),
        ("AW1", "United States"),
        ("AW2", "us"),
        ("AW3", "n/a"),
        ("AW4", "n/a"),
        ("AW5", "France"),
        ("AW6", "United States"),
    ]


def test_categories_keep_the_last_change(spark):
    raw = bronze(
        spark,
        "erp_px_cat_g1v2",
        [("A", "x", "y", "Yes", T(2024, 1, 1)), ("A", "x", "z", "No", T(2024, 1, 2))],
    )
    assert values(silver.clean_categories(raw, NOW), "id", "subcat", "maintenance") == [("A", "z", "No")]


@pytest.mark.parametrize(
    ("crm", "erp", "expected"),
    [
        ("Male", "Female", "Male"),
        ("n/a", "Female", "Female"),
        ("n/a", None, "n/a"),
        (None, "Male", "Male"),
        (None, None, "n/a"),
    ],
)
def test_merged_gender(spark, crm, erp, expected):
    df = spark.createDataFrame([(crm, erp)], "crm string, erp string")
    assert df.select(codes.merged_gender(F.col("crm"), F.col("erp"))).first()[0] == expected


def test_keys(spark):
    df = spark.range(1)
    row = df.select(
        text.padded_key("CUST", F.lit(7), 3).alias("a"),
        text.padded_key("CUST", F.lit(12345), 3).alias("b"),
        text.without_prefix(F.lit("NAS")).alias("c"),
        F.length(text.log_text(F.lit("x" * 300))).alias("d"),
        amounts.rounded_unit_price(F.lit(10.05), F.lit(2.0)).cast("string").alias("e"),
        amounts.rounded_unit_price(F.lit(10.05), F.lit(0.0)).alias("f"),
        dates.whole_seconds(F.lit(T(2024, 1, 1)), F.lit(T(2024, 1, 1, 0, 1, 0, 600_000))).alias("g"),
    ).first()
    assert tuple(row) == ("CUST007", "CUST12345", "", 255, "5.03", None, 61)


def silver_star(spark):
    customers = spark.createDataFrame(
        [(20, "AW2", "Bo", "X", "n/a", "n/a", D(2024, 1, 1), NOW), (10, "AW1", "Al", "Y", "n/a", "Male", D(2024, 1, 1), NOW)],
        schema_of("silver", "crm_cust_info"),
    )
    erp = spark.createDataFrame([("AW2", D(1980, 1, 1), "Female", NOW)], schema_of("silver", "erp_cust_az12"))
    places = spark.createDataFrame([("AW1", "Germany", NOW)], schema_of("silver", "erp_loc_a101"))
    products = spark.createDataFrame(
        [
            (2, "AC_HE", "Z1", "new", None, "Road", D(2012, 7, 1), None, NOW),
            (1, "AC_HE", "Z1", "old", None, "Road", D(2011, 7, 1), D(2012, 6, 30), NOW),
            (3, "XX_XX", "Z2", "odd", None, "Road", D(2011, 7, 1), None, NOW),
        ],
        schema_of("silver", "crm_prd_info"),
    )
    categories = spark.createDataFrame([("AC_HE", "Acc", "Helmet", "Yes", NOW)], schema_of("silver", "erp_px_cat_g1v2"))
    sales = spark.createDataFrame(
        [
            ("SO1", "Z1", 10, D(2011, 7, 1), None, None, 1, 1, 1, NOW),
            ("SO2", "Z1", 20, D(2012, 6, 30), None, None, 1, 1, 1, NOW),
            ("SO3", "Z1", 20, D(2012, 7, 1), None, None, 1, 1, 1, NOW),
            ("SO4", "Z1", 99, D(2000, 1, 1), None, None, 1, 1, 1, NOW),
            ("SO5", "Z9", None, None, None, None, 1, 1, 1, NOW),
        ],
        schema_of("silver", "crm_sales_details"),
    )
    return {
        "crm_cust_info": customers,
        "erp_cust_az12": erp,
        "erp_loc_a101": places,
        "crm_prd_info": products,
        "erp_px_cat_g1v2": categories,
        "crm_sales_details": sales,
    }


def test_gold(spark):
    tables = gold.build_gold(silver_star(spark))
    for name, df in tables.items():
        assert df.schema.simpleString() == schema_of("gold", name).simpleString()
    assert values(tables["dim_customers"], "customer_key", "customer_id", "country", "gender", "birthdate") == [
        (1, 10, "Germany", "Male", None),
        (2, 20, None, "Female", D(1980, 1, 1)),
    ]
    assert values(tables["dim_products"], "product_key", "product_id", "category_name") == [
        (1, 1, "Acc"),
        (2, 3, None),
        (3, 2, "Acc"),
    ]
    fan_out = values(tables["fact_sales"], "order_number", "product_key", "customer_key")
    assert fan_out == sorted(
        [("SO1", 1, 1), ("SO1", 3, 1), ("SO2", 1, 2), ("SO2", 3, 2), ("SO3", 1, 2), ("SO3", 3, 2),
         ("SO4", 1, None), ("SO4", 3, None), ("SO5", None, None)],
        key=repr,
    )
    as_of = gold.fact_sales_as_of(
        silver_star(spark)["crm_sales_details"], tables["dim_products"], tables["dim_customers"]
    )
    assert as_of.schema.simpleString() == schema_of("gold", "fact_sales").simpleString()
    assert values(as_of, "order_number", "product_key", "customer_key") == [
        ("SO1", 1, 1),
        ("SO2", 1, 2),
        ("SO3", 3, 2),
        ("SO4", None, None),
        ("SO5", None, None),
    ]


def test_saved_gold_table_is_replaced(spark):
    df = spark.range(3)
    for rows in (df, df.limit(2)):
        gold.save_as_table(rows, "saved_gold")
    assert spark.table("saved_gold").count() == 2
    spark.sql("DROP TABLE saved_gold")
