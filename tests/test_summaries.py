"""Summaries, their storage, and the queries that must agree with each other."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from decimal import Decimal

import pytest
from plans import physical
from pyspark.sql import functions as F

from stratoform.catalog import all_queries
from stratoform.model import views
from stratoform.operators.bloom import BloomFilter
from stratoform.plans import quality, sales, sketches, summaries
from stratoform.session import scratch_path

D = dt.date
SALES = """sale_id int, customer_id int, product_id int, sale_date date, quantity bigint,
           unit_price decimal(10,2), net_amount decimal(12,4)"""


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def star(spark):
    def sale(i, customer, product, day, net):
        return (i, customer, product, D(2024, 1, day), 2, Decimal("5.00"), Decimal(net))

    fact = spark.createDataFrame(
        [
            sale(1, 1, 10, 1, "10.0000"),
            sale(2, 1, 10, 1, "20.5000"),
            sale(3, 1, 11, 2, "30.0000"),
            sale(4, 2, 10, 3, "40.0000"),
            sale(5, 9, 99, 3, "1.0000"),
        ],
        SALES,
    )
    customers = spark.createDataFrame(
        [(1, "Ann", "NY", "F"), (2, "Bo", "CA", "M"), (3, "Cy", "CA", "M")],
        "customer_id int, customer_name string, region string, gender string",
    )
    products = spark.createDataFrame(
        [(10, "Cap", "Acc", Decimal("5.00")), (11, "Bag", "Acc", Decimal("6.00")), (12, "Pen", "Pap", Decimal("1.00"))],
        "product_id int, product_name string, category_name string, list_price decimal(10,2)",
    )
    return fact, customers, products


def test_members_without_sales_are_kept(star):
    fact, customers, products = star
    by_customer = summaries.customer_sales(fact, customers)
    assert rows(by_customer, "customer_id", "total_purchases", "total_spent", "avg_purchase_amount") == [
        (1, 3, Decimal("60.5000"), 60.5 / 3),
        (2, 1, Decimal("40.0000"), 40.0),
        (3, 0, None, None),
    ]
    enhanced = summaries.customer_enhanced(fact, customers)
    assert rows(enhanced, "customer_id", "first_purchase_date", "unique_products_bought", "max_product_id") == [
        (1, D(2024, 1, 1), 2, 11),
        (2, D(2024, 1, 3), 1, 10),
        (3, None, 0, None),
    ]
    by_product = summaries.product_performance(fact, products)
    assert rows(by_product, "product_id", "total_sales", "total_quantity_sold", "avg_price") == [
        (10, 3, 6, 5.0),
        (11, 1, 2, 5.0),
        (12, 0, None, None),
    ]
    enhanced = summaries.product_enhanced(fact, products)
    assert rows(enhanced, "product_id", "unique_customers", "min_customer_id", "total_sales") == [
        (10, 2, 1, 3),
        (11, 1, 1, 1),
        (12, 0, None, 0),
    ]


def test_queries_on_the_star(star):
    fact, customers, products = star
    by_customer = sales.totals(fact, "customer_id")
    assert rows(sales.customer_analysis(by_customer, customers)) == [
        ("CA", 1, 1, Decimal("40.0000"), 40.0),
        ("NY", 1, 3, Decimal("60.5000"), 60.5 / 3),
    ]
    assert rows(sales.top_customers(by_customer, customers, more_than=2)) == [("Ann", "NY", 3, Decimal("60.5000"))]
    assert rows(sales.top_customers(by_customer, customers, more_than=3)) == []
    assert rows(sales.product_performance(sales.totals(fact, "product_id"), products), "category_name", "total_sales") == [
        ("Acc", 4)
    ]
    located = fact.join(sales.in_regions(customers, ["CA"]).select("customer_id", "region"), "customer_id")
    assert rows(sales.daily_by_region(located), "sale_date", "region", "total_sales") == [(D(2024, 1, 3), "CA", 1)]
    assert rows(sales.bought_pairs(fact, customers.where("customer_id = 1"), products)) == [(1, 10), (1, 11)]
    assert rows(sales.lookup(customers, "customer_id", by_customer)) == [(1, True, 3), (2, True, 1), (3, False, 0)]
    subsets = {"all": F.lit(True), "none": F.col("net_amount") > 1000}
    assert rows(sales.distinct_customers(fact, subsets)) == [("all", 3), ("none", 0)]


def test_mean_of_means_differs_from_the_mean(star):
    fact, customers, _ = star
    everyone = customers.withColumn("region", F.lit("X")).withColumn("gender", F.lit("Y"))
    summary = summaries.customer_enhanced(fact, everyone)
    literal = summaries.segmentation(everyone, summary).first()
    exact = summaries.segmentation_exact(summary).first()
    assert literal["avg_purchase_amount"] == pytest.approx((60.5 / 3 + 40) / 2, abs=1e-4)
    assert exact["avg_purchase_amount"] == pytest.approx(100.5 / 4)
    assert literal["unique_customers"] == exact["unique_customers"] == 2
    later = summaries.segmentation(everyone, summary, first_purchase=D(2024, 1, 2)).first()
    assert (later["unique_customers"], later["total_revenue"]) == (1, Decimal("40.0000"))


@pytest.mark.parametrize("name", sorted(summaries.summaries()))
def test_store(spark, star, tmp_path, name):
    fact, customers, products = star
    summary = replace(summaries.summaries()[name], name=f"{name}_{uuid.uuid4().hex}")
    store = summaries.SummaryStore(spark, f"file://{tmp_path}/store")
    inputs = lambda sales: {"sales": sales, "customers": customers, "products": products}
    early, late = fact.where("sale_id <= 3"), fact.where("sale_id > 3")
    whole = summary.build(inputs(fact))
    store.create(summary, inputs(early))
    before = rows(store.read(summary.name))
    store.create(summary, inputs(fact))
    assert rows(store.read(summary.name)) == before  # it exists, so it is left as it is
    reader = store.read(summary.name)
    for _ in range(2):
        store.refresh_incremental(summary.name, inputs(late), "late")
        assert rows(store.read(summary.name)) == rows(whole)
    assert rows(reader) == before  # a reader keeps the version it opened
    assert store.read(summary.name).schema.simpleString() == whole.schema.simpleString()
    for _ in range(3):
        store.refresh(summary.name, inputs(fact))
    assert rows(store.read(summary.name)) == rows(whole)
    assert len(list((tmp_path / "store" / summary.name).iterdir())) == 2


@pytest.mark.parametrize(
    ("one", "other"),
    [
        ("daily_from_mv", "daily_sales_aggregation"),
        ("zone_pruned_daily", "daily_region_sales"),
        ("mv_refresh_incremental", "mv_daily_sales"),
        ("stream_upsert_latest", "upsert_latest"),
    ],
)
def test_variants_agree(spark, sf_dir, one, other):
    queries = all_queries()
    left, right = queries[one].build(spark, sf_dir), queries[other].build(spark, sf_dir)
    columns = sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)


def test_prefilter_changes_nothing(spark, sf_dir):
    buyers = views.buyers(spark, sf_dir)
    members = views.dim_customers(spark, sf_dir).where("gender = 'AUTOMOBILE'").select("customer_id")
    known = BloomFilter.build(members, "customer_id", members.count())
    exact = rows(buyers.join(members, "customer_id", "left_semi").select(*buyers.columns))
    filtered = sketches.prefiltered(buyers, "customer_id", members, "customer_id", known)
    assert filtered.columns == buyers.columns and rows(filtered, *buyers.columns) == exact


def test_pair_accuracy_without_pairs(spark):
    none = spark.createDataFrame([], "customer_id int, product_id int")
    ids = spark.createDataFrame([(1,)], "customer_id int"), spark.createDataFrame([(2,)], "product_id int")
    row = sketches.pair_accuracy(*ids, none).first()
    assert (row["estimated_pairs"], row["exact_pairs"], row["recall"], row["precision"]) == (1, 0, None, 0.0)


# --- plans -----------------------------------------------------------------


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = physical(all_queries()["daily_sales_aggregation"].build(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)]" in plan
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in plan
    assert "orders" not in plan


def test_incremental_filter_reaches_the_scan(spark, sf_dir):
    plan = physical(all_queries()["incremental_extract"].build(spark, sf_dir))
    assert "GreaterThan(ts," in plan


def test_nothing_is_broadcast_by_force(spark, sf_dir):
    """With broadcasts switched off no plan of the star still has one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("customer_analysis", "top_customers", "daily_region_sales", "customer_product_pairs", "clean_products"):
            assert "Broadcast" not in physical(all_queries()[name].build(spark, sf_dir)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- quality ---------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, " a", 0, D(2024, 1, 2), D(2024, 1, 1)), (1, "b", 20240101, None, None), (None, None, 9, D(1999, 1, 1), D(2000, 1, 1))],
        "k int, s string, n int, a date, b date",
    )
    card = quality.scorecard(
        {
            "spaces": quality.untrimmed(df, "s"),
            "domain": quality.outside_domain(df, "s", ["b"]),
            "interval": quality.reversed_interval(df, "a", "b"),
            "order": quality.reversed_dates(df, "a", ["b"]),
            "int dates": quality.bad_int_dates(df, "n"),
            "unique": quality.duplicate_keys(df, "k"),
            "missing": quality.missing_keys(df, "k"),
            "orphans": quality.orphans(df, "k", spark.createDataFrame([(1,)], "id int"), "id"),
            "years": quality.outside_years(df, "a", 2024, 2024),
            "clean": quality.untrimmed(df.where("s = 'b'"), "s"),
        }
    )
    assert {r["check_name"]: r["violations"] for r in card.collect()} == {
        "spaces": 1, "domain": 2, "interval": 1, "order": 1, "int dates": 2, "unique": 1, "missing": 1,
        "orphans": 1, "years": 2, "clean": 0,
    }
    assert card.where("passed").count() == 1
    assert rows(quality.bad_int_dates(df, "n")) == [(9,), (None,)]


def test_inconsistent_amounts(spark):
    data = [(10, 2, 5), (10, 2, 5), (11, 2, 5), (11, 2, 5), (None, 2, 5), (0, 0, 0), (-10, -2, 5)]
    df = spark.createDataFrame(data, "s int, q int, p int")
    found = quality.inconsistent_amounts(df, "s", "q", "p")
    assert rows(found) == sorted([(11, 2, 5), (None, 2, 5), (0, 0, 0), (-10, -2, 5)], key=repr)
