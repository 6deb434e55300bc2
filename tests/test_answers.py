"""Questions answered from stored summaries equal those answered from the sales."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plans import physical
from stratoform.catalog.summaries import answers as stored_answers
from stratoform.model import views
from stratoform.plans import summaries
from stratoform.plans.answers import Answers, Condition, Question, cuboids_of

D = dt.date
SALES = """sale_id int, customer_id int, product_id int, sale_date date, quantity bigint,
           unit_price decimal(10,2), net_amount decimal(12,4)"""


def rows(df):
    return sorted((tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def answers(spark, tmp_path_factory):
    rng = random.Random(1)
    data = [
        (i, rng.choice([None, 1, 2, 3, 4, 9]), rng.randrange(10, 15), rng.choice([None, *(D(2023, m, d) for m in (1, 2, 12) for d in (1, 2)), D(2024, 1, 5)]),
         rng.choice([None, 1, 2]), Decimal("5.00"), Decimal(rng.randrange(1, 900)) / 10)
        for i in range(300)
    ]
    sales = spark.createDataFrame(data, SALES).repartition(4)
    customers = spark.createDataFrame(
        [(1, "Ann", "NY", "F"), (2, "Bo", "CA", "M"), (3, "Cy", "CA", "M"), (4, "Di", "NY", "M"), (5, "Eve", "TX", "F")],
        "customer_id int, customer_name string, region string, gender string",
    )
    products = spark.createDataFrame(
        [(i, f"p{i}", "Acc" if i % 2 else "Pap", Decimal("5.00")) for i in range(10, 16)],
        "product_id int, product_name string, category_name string, list_price decimal(10,2)",
    )
    store = summaries.SummaryStore(spark, f"file://{tmp_path_factory.mktemp('answers')}/store")
    stored = {}
    for name, summary in summaries.summaries().items():
        stored[name] = f"{name}_{uuid.uuid4().hex}"
        store.create(replace(summary, name=stored[name]), {"sales": sales, "customers": customers, "products": products})
    attributes = {"customer_id": customers, "product_id": products.drop("list_price")}
    return Answers(sales, attributes, cuboids_of(store, stored))


SINCE = Condition("sale_date", low=D(2023, 2, 1))
QUESTIONS = {
    "daily": Question(("total_sales", "total_revenue", "avg_sale_amount"), ("sale_date",), (SINCE,)),
    "monthly": Question(("total_sales", "total_revenue", "avg_sale_amount"), ("year", "month"), (SINCE,)),
    "segments": Question(("unique_customers", "total_revenue", "avg_sale_amount"), ("region", "gender")),
    "recent customers": Question(("unique_customers",), (), (SINCE,)),
    "categories": Question(("total_quantity", "avg_price", "unique_products"), ("category_name",)),
    "regions of a category": Question(("total_sales", "unique_products"), ("region",), (Condition("category_name", values=("Acc",)),)),
    "last day of a customer": Question(("first_day", "last_day", "active_days"), ("customer_id",)),
    "quarter": Question(("unique_products", "total_revenue"), ("quarter",), (Condition("month", high=2),)),
    "all": Question(("total_sales", "total_quantity", "total_revenue")),
    "nothing": Question(("total_sales", "total_revenue"), (), (Condition("sale_date", low=D(2030, 1, 1)),)),
}


@pytest.mark.parametrize("name", QUESTIONS)
def test_every_fitting_summary_gives_the_answer_of_the_sales(answers, name):
    question = QUESTIONS[name]
    fit = answers.fitting(question)
    assert fit, name
    base = rows(answers.answer(question, "sales"))
    for cuboid in fit:
        assert rows(answers.answer(question, cuboid.name)) == base, cuboid.name
    assert answers.chosen(question) == fit[0].name and fit[0].size == min(c.size for c in fit)


def test_base_equals_a_plain_query(answers):
    known = answers.sales.join(answers.attributes["customer_id"], "customer_id")
    plain = known.groupBy("region", "gender").agg(
        F.count_distinct("customer_id").alias("unique_customers"), F.sum("net_amount").alias("total_revenue"), F.avg("net_amount").alias("avg_sale_amount")
    )
    found = rows(answers.answer(QUESTIONS["segments"], "sales"))
    assert [(a, b, c, d) for a, b, c, d, _ in found] == [(a, b, c, d) for a, b, c, d, _ in rows(plain)]
    assert all(abs(x[4] - y[4]) < 1e-3 for x, y in zip(found, rows(plain), strict=True))


def test_the_smallest_that_fits_is_taken(answers):
    assert answers.chosen(QUESTIONS["daily"]) == "mv_daily_sales: days"
    assert answers.chosen(Question(("total_revenue",), ("region",))) == "mv_customer_sales: customers"
    assert answers.chosen(Question(("total_revenue",), ("category_name",))) == "mv_product_performance: products"
    assert answers.chosen(Question(("unique_customers",), ("category_name",))).split(": ")[1] in ("pairs", "products of customers")


def test_what_no_summary_holds_is_answered_from_the_sales(answers):
    across = Question(("total_sales", "unique_customers"), ("month", "category_name", "region"), (SINCE,))
    assert answers.fitting(across) == [] and answers.chosen(across) == "sales"
    found = rows(answers.answer(across))
    plain = (
        answers.sales.where(F.col("sale_date") >= F.lit(D(2023, 2, 1)))
        .join(answers.attributes["customer_id"], "customer_id")
        .join(answers.attributes["product_id"], "product_id")
        .groupBy(F.month("sale_date").cast("bigint").alias("month"), "category_name", "region")
        .agg(F.count(F.lit(1)), F.count_distinct("customer_id"))
    )
    assert found == rows(plain)
    # Pieces are not in the state of days of customers.
    assert all("days of" not in c.name for c in answers.fitting(Question(("total_quantity",), ("sale_date",))))
    with pytest.raises(ValueError):
        answers.answer(across, "mv_daily_sales: days")
    with pytest.raises(ValueError):
        answers.answer(Question(("total_sales",), ("planet",)))
    with pytest.raises(ValueError):
        Question(("joy",))


def test_sales_meet_their_buyers_once(spark, sf_dir):
    """What the summaries do not hold comes from the same rows as they do, without another join."""
    known = stored_answers(spark, sf_dir)
    assert "Join" not in physical(known.sales)
    assert known.sales.count() == views.sales_with_customer(spark, sf_dir).count()


def test_the_customers_state_is_in_two_others(spark, sf_dir):
    sales = views.sales_with_customer(spark, sf_dir).where("sale_id % 5 = 0")
    own = {n: s.state({"sales": sales}) for n, s in summaries.summaries().items()}
    held = summaries.customer_members_of(own["mv_product_enhanced"], own["mv_daily_enhanced"])
    whole = own["mv_customer_enhanced"]
    assert held.schema.simpleString() == whole.schema.simpleString()
    assert held.exceptAll(whole).count() == whole.exceptAll(held).count() == 0 < whole.count()
