"""Stored summaries and the queries they answer."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratoform.catalog.analytics import DAILY, DAILY_REGION
from stratoform.catalog.registry import REGIONS, SINCE, query
from stratoform.catalog.sql import mean, with_tables
from stratoform.model import views
from stratoform.plans import sales as sales_plans
from stratoform.plans import summaries as plans
from stratoform.plans.answers import Answers, Condition, Question, cuboids_of
from stratoform.session import SMALL, scratch_path, stage
from stratoform.sources.changes import KeyedTable
from stratoform.sources.partitioned import MonthlyTable


def stored(spark: SparkSession, name: str, df: DataFrame, *sort_by: str) -> DataFrame:
    """The rows of a summary, written in order and read back."""
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    return stage(df, name)


_DAILY_VIEW = with_tables(
    f"""SELECT sale_date, count(*) AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
               {mean("sum(net_amount)", "count(*)")} AS avg_sale_amount
        FROM sales GROUP BY sale_date""",
    "sales",
)


@query("mv_daily_sales", _DAILY_VIEW)
def mv_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, "mv_daily_sales", plans.daily_sales(views.sales(spark, sf_dir)), "sale_date")


def refreshed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary stored up to a day, the later sales added, and added once more as after a retry."""
    inputs = {"customers": views.dim_customers(spark, sf_dir), "products": views.dim_products(spark, sf_dir)}
    sales = views.sales_with_customer(spark, sf_dir)
    later = F.col("sale_date") >= F.lit(SINCE)
    store = plans.SummaryStore(spark, scratch_path(spark, "summaries"), temporary=True)
    summary = replace(plans.summaries()[name], name=f"{name}_{uuid.uuid4().hex}")
    store.create(summary, inputs | {"sales": sales.where(~later)})
    for _ in range(2):
        store.refresh_incremental(summary.name, inputs | {"sales": sales.where(later)}, batch="later")
    return store.read(summary.name)


def corrected(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary of wrong sales, mended by the signed changes of the sales table.

    The table first has wrong days, buyers, products and amounts, lines that do
    not exist and no recent sales. A load corrects and adds, another one
    deletes; the summary takes the difference of the two versions, twice.
    """
    inputs = {"customers": views.dim_customers(spark, sf_dir), "products": views.dim_products(spark, sf_dir)}
    sales = views.sales_with_customer(spark, sf_dir)
    # A sale may have several lines of one number; they are told apart by their place.
    alike = Window.partitionBy("sale_id", "line_number").orderBy(*[c for c in sales.columns if c not in ("sale_id", "line_number")])
    right = stage(sales.withColumns({"place": F.row_number().over(alike), "loaded": F.lit(2)}), "right", codec=SMALL)
    odd = F.col("sale_id") % 10 == 3
    wrong = right.where((F.col("sale_date") < F.lit(SINCE)) | odd).withColumns(
        {
            "loaded": F.lit(1),
            "sale_date": F.when(odd, F.date_sub("sale_date", 400)).otherwise(F.col("sale_date")),
            "customer_id": F.when(odd, F.col("customer_id") + 1).otherwise(F.col("customer_id")),
            "product_id": F.when(odd, F.col("product_id") % 7).otherwise(F.col("product_id")),
            "quantity": F.when(odd, F.col("quantity") + 3).otherwise(F.col("quantity")),
        }
    )
    extra = right.where("sale_id % 13 = 5").withColumns({"line_number": F.col("line_number") + 100, "loaded": F.lit(1)})
    table = KeyedTable(scratch_path(spark, "sales"), ("sale_id", "line_number", "place"), ("loaded",))
    table.replace(wrong.unionByName(extra))
    store = plans.SummaryStore(spark, scratch_path(spark, "summaries"), temporary=True)
    summary = replace(plans.summaries()[name], name=f"{name}_{uuid.uuid4().hex}")
    store.create(summary, inputs | {"sales": table.read(spark)})
    before = table.version(spark)
    table.upsert(right.where((F.col("sale_date") >= F.lit(SINCE)) | odd))
    table.delete(extra)
    # Read by the first refresh only, in one pass; the second one finds the batch in the summary.
    changes = table.changes_between(spark, before, table.version(spark))
    for _ in range(2):
        store.refresh_incremental(summary.name, inputs | {"sales": changes}, batch="corrections")
    return store.read(summary.name)


def _register_refresh(suffix: str, name: str, sql: str) -> None:
    @query(f"mv_refresh_{suffix}", sql)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return refreshed(spark, sf_dir, name)

    @query(f"mv_corrected_{name.removeprefix('mv_')}", sql)
    def mended(spark: SparkSession, sf_dir: str) -> DataFrame:
        return corrected(spark, sf_dir, name)


_register_refresh("incremental", "mv_daily_sales", _DAILY_VIEW)


@query("daily_from_mv", DAILY)
def daily_from_mv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily query, answered without the fact."""
    summary = mv_daily_sales(spark, sf_dir)
    return plans.daily_since(summary, SINCE).drop("total_quantity")


def customer_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_customer = views.totals_by_customer(views.sales(spark, sf_dir), views.buyers(spark, sf_dir))
    return plans.customer_sales_from(by_customer, views.dim_customers(spark, sf_dir))


_CUSTOMER_COLUMNS = "customer_id, customer_name, region, total_purchases, total_spent, avg_purchase_amount"


_register_refresh(
    "customer_sales", "mv_customer_sales", with_tables(f"SELECT {_CUSTOMER_COLUMNS} FROM by_customer", "by_customer")
)


@query("mv_customer_sales", with_tables(f"SELECT {_CUSTOMER_COLUMNS} FROM by_customer", "by_customer"))
def mv_customer_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, "mv_customer_sales", customer_sales(spark, sf_dir))


@query(
    "mv_filter_customers",
    with_tables(f"SELECT {_CUSTOMER_COLUMNS} FROM by_customer WHERE total_spent > 2000000", "by_customer"),
)
def mv_filter_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.above(mv_customer_sales(spark, sf_dir), "total_spent", 2_000_000)


_PRODUCT_COLUMNS = """product_id, product_name, category_name, total_sales, total_quantity_sold, total_revenue,
                      avg_price"""


_register_refresh(
    "product_performance",
    "mv_product_performance",
    with_tables(f"SELECT {_PRODUCT_COLUMNS} FROM by_product", "by_product"),
)


@query("mv_product_performance", with_tables(f"SELECT {_PRODUCT_COLUMNS} FROM by_product", "by_product"))
def mv_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = plans.product_performance(views.sales(spark, sf_dir), views.dim_products(spark, sf_dir))
    return stored(spark, "mv_product_performance", summary)


@query(
    "mv_filter_products",
    with_tables(f"SELECT {_PRODUCT_COLUMNS} FROM by_product WHERE total_revenue > 1500000", "by_product"),
)
def mv_filter_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.above(mv_product_performance(spark, sf_dir), "total_revenue", 1_500_000)


def daily_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = plans.daily_enhanced(views.sales_with_customer(spark, sf_dir), views.sales(spark, sf_dir))
    return stored(spark, "mv_daily_sales_enhanced", summary, "sale_date")


_register_refresh(
    "daily_enhanced",
    "mv_daily_enhanced",
    with_tables("SELECT * EXCLUDE (net), CAST(net AS DOUBLE) AS total_revenue FROM daily", "daily"),
)
_register_refresh("customer_enhanced", "mv_customer_enhanced", with_tables("SELECT * FROM by_customer", "by_customer"))
_register_refresh(
    "product_enhanced",
    "mv_product_enhanced",
    with_tables("SELECT * EXCLUDE (avg_price), avg_price AS avg_sale_price FROM by_product", "by_product"),
)


@query(
    "mv_daily_enhanced",
    with_tables("SELECT * EXCLUDE (net), CAST(net AS DOUBLE) AS total_revenue FROM daily", "daily"),
)
def mv_daily_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_enhanced(spark, sf_dir)


def customer_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = plans.customer_enhanced(
        views.sales_with_customer(spark, sf_dir), views.dim_customers(spark, sf_dir)
    )
    return stored(spark, "mv_customer_analysis_enhanced", summary)


@query("mv_customer_enhanced", with_tables("SELECT * FROM by_customer", "by_customer"))
def mv_customer_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_enhanced(spark, sf_dir)


@query(
    "mv_product_enhanced",
    with_tables("SELECT * EXCLUDE (avg_price), avg_price AS avg_sale_price FROM by_product", "by_product"),
)
def mv_product_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = plans.product_enhanced(
        views.sales_with_customer(spark, sf_dir), views.dim_products(spark, sf_dir)
    )
    return stored(spark, "mv_product_performance_enhanced", summary)


@query(
    "segmentation_from_mv",
    with_tables(
        """SELECT region, gender, count(*) AS unique_customers, CAST(sum(net) AS DOUBLE) AS total_revenue,
                  CAST(sum((2 * CAST(net * 10000 AS HUGEINT) + n) // (2 * n)) AS DOUBLE) / 10000 / count(*)
                      AS avg_purchase_amount
           FROM (SELECT region, gender, sum(net_amount) AS net, count(*) AS n
                 FROM customers c JOIN sales s ON c.customer_id = s.customer_id
                 GROUP BY c.customer_id, region, gender HAVING min(sale_date) >= DATE '1995-06-01')
           GROUP BY region, gender""",
        "customers",
        "sales",
    ),
)
def segmentation_from_mv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of the customers' means, among customers who first bought after a day."""
    return plans.segmentation(
        views.dim_customers(spark, sf_dir), customer_enhanced(spark, sf_dir), first_purchase=dt.date(1995, 6, 1)
    )


@query(
    "segmentation_exact_rollup",
    with_tables(
        f"""SELECT region, gender, count(DISTINCT c.customer_id) AS unique_customers,
                   CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
                   {mean("sum(net_amount)", "count(sale_id)")} AS avg_purchase_amount
            FROM customers c JOIN sales s ON c.customer_id = s.customer_id GROUP BY region, gender""",
        "customers",
        "sales",
    ),
)
def segmentation_exact_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.segmentation_exact(customer_enhanced(spark, sf_dir))


@query(
    "range_join_zone",
    with_tables(
        """SELECT sale_date, region, count(*) AS total_sales, CAST(net AS DOUBLE) * count(*) AS total_revenue,
                  avg_sale_amount
           FROM daily JOIN customers ON min_customer_id <= customer_id AND max_customer_id >= customer_id
           WHERE sale_date >= DATE '1998-01-01' AND region IN ('AMERICA', 'ASIA', 'EUROPE')
           GROUP BY sale_date, region, net, avg_sale_amount""",
        "daily",
        "customers",
    ),
)
def range_join_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = plans.daily_since(daily_enhanced(spark, sf_dir), SINCE)
    return plans.zone_totals(daily, sales_plans.in_regions(views.dim_customers(spark, sf_dir), REGIONS))


_STORED: dict[tuple[str, str], tuple[MonthlyTable, str]] = {}


def stored_star(spark: SparkSession, sf_dir: str) -> tuple[MonthlyTable, DataFrame]:
    """The fact by month and the daily summary, as a warehouse has them; the application's first call writes them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        fact = MonthlyTable(scratch_path(spark, "fact-by-month"), "sale_date")
        columns = ["sale_date", "customer_id", "quantity", "unit_price", "net_amount"]
        fact.write(views.sales_with_customer(spark, sf_dir).select(*columns), "customer_id")
        path = scratch_path(spark, "daily-zones")
        stage(plans.daily_enhanced(views.sales_with_customer(spark, sf_dir), views.sales(spark, sf_dir)), "", path)
        _STORED[key] = fact, path
    fact, path = _STORED[key]
    return fact, spark.read.parquet(path)


@query("zone_pruned_daily", DAILY_REGION)
def zone_pruned_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent sales by day and region, with days skipped by the stored daily summary, and months by the days."""
    fact, daily = stored_star(spark, sf_dir)
    wanted = sales_plans.in_regions(views.dim_customers(spark, sf_dir), REGIONS)
    return plans.zone_pruned_daily(plans.daily_since(daily, SINCE), wanted, fact, SINCE)


def answers(spark: SparkSession, sf_dir: str) -> Answers:
    """The six summaries, stored, and the sales behind them, which meet their buyers once for all."""
    customers, products = views.dim_customers(spark, sf_dir), views.dim_products(spark, sf_dir)
    sales = views.sales_with_customer(spark, sf_dir).select("sale_date", "customer_id", "product_id", *plans.MEASURED)
    inputs = {"sales": stage(sales, "sales", codec=SMALL), "customers": customers, "products": products}
    store = plans.SummaryStore(spark, scratch_path(spark, "summaries"), temporary=True)
    names = {}
    found = plans.summaries()
    # Last the one whose state two others hold.
    for name in sorted(found, key=lambda n: n == "mv_customer_enhanced"):
        names[name] = f"{name}_{uuid.uuid4().hex}"
        held = None
        if name == "mv_customer_enhanced":
            held = plans.customer_members_of(*[store.state(names[n]) for n in ("mv_product_enhanced", "mv_daily_enhanced")])
        store.create(replace(found[name], name=names[name]), inputs, state=held)
    attributes = {"customer_id": customers, "product_id": products.select("product_id", "product_name", "category_name")}
    return Answers(inputs["sales"], attributes, cuboids_of(store, names))


_RECENT = Condition("sale_date", low=SINCE)
_QUESTIONS = {
    "daily": Question(("total_sales", "total_revenue"), ("sale_date",), (_RECENT,)),
    "monthly": Question(("total_sales", "total_revenue"), ("year", "month"), (_RECENT,)),
    "segments": Question(("total_sales", "total_revenue", "unique_customers"), ("region", "gender")),
    "recent": Question(("unique_customers",), (), (_RECENT,)),
    "categories": Question(("total_quantity", "unique_customers"), ("category_name",)),
    "across": Question(("total_sales", "unique_customers"), ("region", "category_name"), (_RECENT,)),
}


@query(
    "answers_by_view",
    with_tables(
        """SELECT 'daily' AS question, CAST(sale_date AS VARCHAR) AS part, '' AS other, count(*) AS total_sales,
                  CAST(sum(net_amount) AS DOUBLE) AS total_revenue, CAST(NULL AS BIGINT) AS members FROM recent GROUP BY sale_date
           UNION ALL SELECT 'monthly', CAST(extract(year FROM sale_date) AS VARCHAR), CAST(extract(month FROM sale_date) AS VARCHAR),
                  count(*), CAST(sum(net_amount) AS DOUBLE), NULL FROM recent GROUP BY 2, 3
           UNION ALL SELECT 'segments', region, gender, count(*), CAST(sum(net_amount) AS DOUBLE), count(DISTINCT customer_id)
                  FROM sales JOIN customers USING (customer_id) GROUP BY region, gender
           UNION ALL SELECT 'recent', '', '', NULL, NULL, count(DISTINCT customer_id) FROM recent
           UNION ALL SELECT 'categories', category_name, '', CAST(sum(quantity) AS BIGINT), NULL, count(DISTINCT customer_id)
                  FROM sales JOIN products USING (product_id) GROUP BY category_name
           UNION ALL SELECT 'across', region, category_name, count(*), NULL, count(DISTINCT customer_id)
                  FROM recent JOIN customers USING (customer_id) JOIN products USING (product_id) GROUP BY region, category_name""",
        "recent",
        "customers",
        "products",
    ),
)
def answers_by_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six questions, each answered from the smallest summary that holds it; the last one no summary holds."""
    known = answers(spark, sf_dir)
    shown = []
    for name, question in _QUESTIONS.items():
        found = known.answer(question)
        groups = [F.col(g).cast("string") for g in question.groups] + [F.lit("")] * (2 - len(question.groups))
        of = lambda *names, q=question: next((F.col(n) for n in names if n in q.measures), F.lit(None))
        shown.append(
            found.select(
                F.lit(name).alias("question"),
                groups[0].alias("part"),
                groups[1].alias("other"),
                of("total_sales", "total_quantity").cast("bigint").alias("total_sales"),
                of("total_revenue").cast("double").alias("total_revenue"),
                of("unique_customers").cast("bigint").alias("members"),
            )
        )
    return reduce(DataFrame.unionByName, shown)
