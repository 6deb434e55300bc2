"""Stored summaries: definitions, refresh, and queries answered from them.

A summary keeps sums and counts next to the averages shown, so that coarser
results are computed from sums and never from averages.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.functions.amounts import mean
from stratoform.operators.zones import count_points_in_zones
from stratoform.plans.sales import daily_by_region, totals
from stratoform.session import SMALL, remove, stage
from stratoform.sources.partitioned import MonthlyTable

# --- definitions -----------------------------------------------------------
#
# Each summary is shown from a state that is a sum over sales: totals per day,
# member, (day, member), (customer, day) or (customer, product). A sale may have
# a sign, -1 for one that is taken back, so a correction is two sales and a
# deletion one. Days and members are counted multisets, rows of the state with
# the number of their lines: what has no line left is gone, and so distinct
# counts, smallest and largest ones stay exact when sales go.

_SUMS = ("lines", "pieces", "net", "price_sum")
#: 1 for a sale that is added, -1 for one that is taken back; sales without the column are added.
SIGN = "weight"
_MEASURES = {"pieces": "quantity", "net": "net_amount", "price_sum": "unit_price"}
#: The columns of a sale that are added up.
MEASURED = tuple(_MEASURES.values())


def signed_parts(sales: DataFrame, *others: str | Column) -> DataFrame:
    """Each sale's signed measures, and in ``…_n`` its sign where it has the value; sums of these make a state."""
    sign = F.col(SIGN) if SIGN in sales.columns else F.lit(1)
    columns = [sign.cast("bigint").alias("lines")]
    for name, value in _MEASURES.items():
        signed = (F.col(value) * sign).cast(sales.schema[value].dataType)
        columns += [signed.alias(name), F.when(F.col(value).isNotNull(), sign).cast("bigint").alias(f"{name}_n")]
    return sales.select(*others, *columns)


def signed_totals(sales: DataFrame, *keys: str) -> DataFrame:
    """Signed measures of ``totals``, and in ``…_n`` how many sales have the value that was summed."""
    return summed(signed_parts(sales, *keys), *keys)


def summed(parts: DataFrame, *keys: str) -> DataFrame:
    measures = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def added(state: DataFrame, parts: DataFrame, *keys: str) -> DataFrame:
    """A state with the parts of more signed sales; equal to the state of the sales that are left.

    The parts are added up with the state, in one shuffle: few of them meet
    in a row of the states that are large.
    """
    same = parts.select(*[F.col(f.name).cast(f.dataType) for f in state.schema])
    whole = summed(state.unionByName(same), *keys).where("lines <> 0")
    # A sum of sums is wider by ten digits; the stored type stays the same.
    return whole.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema])


def left_over(state: DataFrame) -> DataFrame:
    """The state's rows that have sales; a sum is null where none of them has the value."""
    known = [F.when(F.col(f"{c}_n") > 0, F.col(c)).alias(c) if f"{c}_n" in state.columns else F.col(c) for c in state.columns]
    return state.where("lines > 0").select(*known)


def daily_sales(sales: DataFrame) -> DataFrame:
    return daily_sales_from(totals(sales, "sale_date"))


def daily_sales_from(by_day: DataFrame) -> DataFrame:
    return by_day.select(
        "sale_date",
        F.col("lines").alias("total_sales"),
        F.col("pieces").alias("total_quantity"),
        F.col("net").alias("total_revenue"),
        mean(F.col("net"), F.col("lines")).alias("avg_sale_amount"),
    )


def _kept(dimension: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """All members, those without sales with zero lines and null sums."""
    return dimension.join(parts, key, "left").withColumn(
        "lines", F.coalesce("lines", F.lit(0).cast("bigint"))
    )


def customer_sales(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return customer_sales_from(totals(sales, "customer_id"), customers)


def customer_sales_from(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """As ``customer_sales``, for totals per customer that exist already."""
    return _kept(customers, by_customer, "customer_id").select(
        "customer_id",
        "customer_name",
        "region",
        F.col("lines").alias("total_purchases"),
        F.col("net").alias("total_spent"),
        mean(F.col("net"), F.col("lines")).alias("avg_purchase_amount"),
    )


def product_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    return product_performance_from(totals(sales, "product_id"), products)


def product_performance_from(by_product: DataFrame, products: DataFrame) -> DataFrame:
    return _kept(products, by_product, "product_id").select(
        "product_id",
        "product_name",
        "category_name",
        F.col("lines").alias("total_sales"),
        F.col("pieces").alias("total_quantity_sold"),
        F.col("net").alias("total_revenue"),
        mean(F.col("price_sum"), F.col("lines")).alias("avg_price"),
    )


def day_members(sales: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Totals per day and customer, and the days' products, as rows of one table.

    Customers and products are taken in two narrow passes. Two distinct
    aggregates in one pass would first write every sale three times. ``lines``
    may give the same sales without the customer, where those come without a
    join.
    """
    by_customer = sales.groupBy("sale_date", F.col("customer_id").alias("member")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net")
    )
    products = (sales if lines is None else lines).select("sale_date", F.col("product_id").alias("member")).distinct()
    by_product = products.select(
        "sale_date", "member", F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast(by_customer.schema["net"].dataType).alias("net")
    )
    return by_customer.withColumn("kind", F.lit("customer")).unionByName(by_product.withColumn("kind", F.lit("product")))


def daily_enhanced(sales: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Daily totals with distinct members and the range of ids of the day."""
    return daily_enhanced_from(day_members(sales, lines))


def daily_enhanced_from(members: DataFrame) -> DataFrame:
    of = lambda kind, column: F.when(F.col("kind") == kind, F.col(column))
    return (
        members.groupBy("sale_date")
        .agg(
            F.sum(of("customer", "lines")).alias("total_sales"),
            F.sum(of("customer", "net")).cast(members.schema["net"].dataType).alias("total_revenue"),
            *[F.count(of(kind, "member")).alias(f"unique_{kind}s") for kind in ("customer", "product")],
            *[
                pick(of(kind, "member")).alias(f"{name}_{kind}_id")
                for kind in ("customer", "product")
                for name, pick in (("min", F.min), ("max", F.max))
            ],
        )
        .withColumn("avg_sale_amount", mean(F.col("total_revenue"), F.col("total_sales")))
        .select(
            "sale_date",
            "total_sales",
            "total_revenue",
            "avg_sale_amount",
            "unique_customers",
            "unique_products",
            "min_customer_id",
            "max_customer_id",
            "min_product_id",
            "max_product_id",
        )
    )


def _kinds(sales: DataFrame, key: str, *members: Column) -> DataFrame:
    """A row for each kind of member of each sale, from one pass over the sales, whose buyers take a join."""
    parts = signed_parts(sales, key, F.explode(F.array(*members)).alias("_of"))
    return parts.select("_of.kind", key, *[f"_of.{c}" for c in parts.schema["_of"].dataType.names[1:]], "lines", "net", "net_n")


def signed_day_members(sales: DataFrame) -> DataFrame:
    """The parts of ``day_members``, from signed sales: products with the number of their lines."""
    of = lambda kind: F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("member"))
    return _kinds(sales, "sale_date", of("customer"), of("product"))


def signed_customer_members(sales: DataFrame) -> DataFrame:
    """Parts of a customer's products and days, as rows of one table; totals are with the products."""
    no_product = F.lit(None).cast(sales.schema["product_id"].dataType)
    by_product = F.struct(F.lit("product").alias("kind"), "product_id", F.lit(None).cast("date").alias("sale_date"))
    by_day = F.struct(F.lit("day").alias("kind"), no_product.alias("product_id"), "sale_date")
    return _kinds(sales, "customer_id", by_product, by_day).select(
        "kind", "customer_id", "product_id", "sale_date", "lines", "net", "net_n"
    )


def customer_members_of(pairs: DataFrame, day_members: DataFrame) -> DataFrame:
    """The sums of ``signed_customer_members`` from those per customer and product and those of ``signed_day_members``."""
    by_product = pairs.withColumns({"kind": F.lit("product"), "sale_date": F.lit(None).cast(day_members.schema["sale_date"].dataType)})
    by_day = day_members.where("kind = 'customer'").select(
        F.lit("day").alias("kind"),
        F.col("member").cast(pairs.schema["customer_id"].dataType).alias("customer_id"),
        F.lit(None).cast(pairs.schema["product_id"].dataType).alias("product_id"),
        *["sale_date", "lines", "net", "net_n"],
    )
    return by_product.select(by_day.columns).unionByName(by_day)


def pair_totals(sales: DataFrame) -> DataFrame:
    """Totals and first and last day per customer and product.

    Grouping its rows by either id gives the distinct number of the other as a
    count, so no row is multiplied for a distinct aggregate.
    """
    return sales.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("pieces"),
        F.sum("net_amount").alias("net"),
        F.sum("unit_price").alias("price_sum"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
    )


def customer_enhanced(sales: DataFrame, customers: DataFrame, segment: str = "gender") -> DataFrame:
    return customer_enhanced_from(pair_totals(sales), customers, segment)


def customer_enhanced_from(pairs: DataFrame, customers: DataFrame, segment: str = "gender") -> DataFrame:
    by_customer = pairs.groupBy("customer_id").agg(
        F.sum("lines").alias("lines"),
        F.sum("net").alias("net"),
        F.min("first_day").alias("first_purchase_date"),
        F.max("last_day").alias("last_purchase_date"),
        F.count("product_id").alias("unique_products"),
        F.min("product_id").alias("min_product_id"),
        F.max("product_id").alias("max_product_id"),
    )
    return _customer_rows(by_customer, customers, segment)


def customer_enhanced_of_members(members: DataFrame, customers: DataFrame, segment: str = "gender") -> DataFrame:
    """As ``customer_enhanced_from``, from the multisets of ``signed_customer_members``."""
    of_product = lambda c: F.when(F.col("kind") == "product", F.col(c))
    by_customer = members.groupBy("customer_id").agg(
        F.sum(of_product("lines")).alias("lines"),
        F.sum(of_product("net")).alias("net"),
        F.min("sale_date").alias("first_purchase_date"),
        F.max("sale_date").alias("last_purchase_date"),
        F.count("product_id").alias("unique_products"),
        F.min("product_id").alias("min_product_id"),
        F.max("product_id").alias("max_product_id"),
    )
    return _customer_rows(by_customer, customers, segment)


def _customer_rows(by_customer: DataFrame, customers: DataFrame, segment: str) -> DataFrame:
    return _kept(customers, by_customer, "customer_id").select(
        "customer_id",
        "customer_name",
        "region",
        segment,
        F.col("lines").alias("total_purchases"),
        F.col("net").alias("total_spent"),
        mean(F.col("net"), F.col("lines")).alias("avg_purchase_amount"),
        "first_purchase_date",
        "last_purchase_date",
        F.coalesce("unique_products", F.lit(0).cast("bigint")).alias("unique_products_bought"),
        "min_product_id",
        "max_product_id",
    )


def product_enhanced(sales: DataFrame, products: DataFrame) -> DataFrame:
    return product_enhanced_from(pair_totals(sales), products)


def product_enhanced_from(pairs: DataFrame, products: DataFrame) -> DataFrame:
    by_product = pairs.groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.count("customer_id").alias("unique_customers"),
        F.min("customer_id").alias("min_customer_id"),
        F.max("customer_id").alias("max_customer_id"),
    )
    return _kept(products, by_product, "product_id").select(
        "product_id",
        "product_name",
        "category_name",
        F.col("list_price").alias("unit_price"),
        F.col("lines").alias("total_sales"),
        F.col("pieces").alias("total_quantity_sold"),
        F.col("net").alias("total_revenue"),
        mean(F.col("price_sum"), F.col("lines")).alias("avg_sale_price"),
        F.coalesce("unique_customers", F.lit(0).cast("bigint")).alias("unique_customers"),
        "min_customer_id",
        "max_customer_id",
    )


# --- storage ---------------------------------------------------------------

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Summary:
    """A named summary: the parts of its state from inputs with signed sales, and the rows shown from a state.

    ``keys`` name a row of the state, which has the sums of its parts. ``show`` gets the rows that have sales, and
    the inputs, for the attributes of members.
    """

    name: str
    parts: Callable[[Inputs], DataFrame]
    keys: tuple[str, ...]
    show: Callable[[DataFrame, Inputs], DataFrame]
    sort_by: tuple[str, ...] = ()

    def state(self, inputs: Inputs) -> DataFrame:
        return summed(self.parts(inputs), *self.keys)

    def build(self, inputs: Inputs) -> DataFrame:
        return self.show(left_over(self.state(inputs)), inputs)


def summaries() -> dict[str, Summary]:
    """The six summaries over the inputs ``sales`` (with customer), ``customers`` and ``products``."""
    of = lambda *keys: lambda inputs: signed_parts(inputs["sales"], *keys)
    found = (
        Summary("mv_daily_sales", of("sale_date"), ("sale_date",), lambda s, _: daily_sales_from(s), ("sale_date",)),
        Summary(
            "mv_customer_sales", of("customer_id"), ("customer_id",), lambda s, i: customer_sales_from(s, i["customers"])
        ),
        Summary(
            "mv_product_performance",
            of("product_id"),
            ("product_id",),
            lambda s, i: product_performance_from(s, i["products"]),
        ),
        Summary(
            "mv_daily_enhanced",
            lambda inputs: signed_day_members(inputs["sales"]),
            ("kind", "sale_date", "member"),
            lambda s, _: daily_enhanced_from(s),
            ("sale_date",),
        ),
        Summary(
            "mv_customer_enhanced",
            lambda inputs: signed_customer_members(inputs["sales"]),
            ("kind", "customer_id", "product_id", "sale_date"),
            lambda s, i: customer_enhanced_of_members(s, i["customers"]),
        ),
        Summary(
            "mv_product_enhanced",
            of("customer_id", "product_id"),
            ("customer_id", "product_id"),
            lambda s, i: product_enhanced_from(s, i["products"]),
        ),
    )
    return {summary.name: summary for summary in found}


@dataclass
class SummaryStore:
    """Summaries as Parquet folders, each behind a catalog view of its name.

    A refresh writes a new folder and then moves the view, so readers never see
    half a refresh and a refresh may read the summary it replaces. A folder has
    the rows shown, the state they came from and the names of the batches that
    are in it, so a batch that is added again changes nothing. The last two
    versions are kept. A temporary store registers its views for the session
    only.
    """

    spark: SparkSession
    path: str
    temporary: bool = False
    defined: dict[str, Summary] = field(default_factory=dict)

    def create(self, summary: Summary, inputs: Inputs, batch: str = "first", state: DataFrame | None = None) -> None:
        """Register and fill the summary unless it exists; ``state`` is given where others hold it already."""
        self.defined[summary.name] = summary
        if not self.spark.catalog.tableExists(summary.name):
            self._publish(summary, summary.state(inputs) if state is None else state, inputs, [batch], [])

    def refresh(self, name: str, inputs: Inputs, batch: str = "first") -> None:
        """Recompute from all inputs."""
        summary = self.defined[name]
        self._publish(summary, summary.state(inputs), inputs, [batch], self._versions(name)[:1])

    def refresh_incremental(self, name: str, new_inputs: Inputs, batch: str) -> None:
        """Add the signed sales of a batch, unless it is in already; reads none of the old sales."""
        summary = self.defined[name]
        now = self._versions(name)
        batches = [r.batch for r in self.spark.read.parquet(f"{now[0]}/batches").where("batch is not null").collect()]
        if batch in batches:
            return
        old = self.spark.read.parquet(f"{now[0]}/state")
        self._publish(summary, added(old, summary.parts(new_inputs), *summary.keys), new_inputs, [*batches, batch], now[:1])

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def state(self, name: str) -> DataFrame:
        """The signed state behind the rows shown."""
        return self.spark.read.parquet(f"{self._versions(name)[0]}/state")

    def _versions(self, name: str) -> list[str]:
        """The folder behind the view, and the one before it if there is one."""
        now = self.read(name).inputFiles()[0].rsplit("/rows/", 1)[0]
        before = self.spark.read.parquet(f"{now}/batches").where("previous is not null").collect()
        return [now, *[r.previous for r in before]]

    def _publish(
        self, summary: Summary, state: DataFrame, inputs: Inputs, batches: list[str], previous: list[str]
    ) -> None:
        folder = f"{self.path}/{summary.name}/{uuid.uuid4().hex}"
        kept = stage(state, summary.name, f"{folder}/state", SMALL)
        df = summary.show(left_over(kept), inputs)
        if summary.sort_by:
            df = df.repartitionByRange(*summary.sort_by).sortWithinPartitions(*summary.sort_by)
        stage(df, summary.name, f"{folder}/rows", SMALL)
        log = [(b, None) for b in batches] + [(None, p) for p in previous]
        log = self.spark.createDataFrame(log, "batch string, previous string").coalesce(1)
        stage(log, summary.name, f"{folder}/batches")
        old = self._versions(summary.name)[1:] if previous else []
        if self.temporary:
            rows = self.spark.read.schema(df.schema).parquet(f"{folder}/rows")
            rows.createOrReplaceTempView(summary.name)
        else:
            self.spark.sql(f"CREATE OR REPLACE VIEW {summary.name} AS SELECT * FROM parquet.`{folder}/rows`")
        for path in old:
            remove(self.spark, path)


# --- answers ---------------------------------------------------------------


def daily_since(summary: DataFrame, day: dt.date) -> DataFrame:
    return summary.where(F.col("sale_date") >= F.lit(day))


def above(summary: DataFrame, measure: str, threshold: int) -> DataFrame:
    return summary.where(F.col(measure) > threshold)


def segmentation(
    customers: DataFrame, summary: DataFrame, segment: str = "gender", first_purchase: dt.date | None = None
) -> DataFrame:
    """Segments from the customer summary, with the mean of the customers' means.

    That mean weighs every customer alike; ``segmentation_exact`` weighs every
    sale alike. The customers' means are taken to four places, as decimals, so
    that their sum does not depend on the order of addition.
    """
    bought = summary.where("total_purchases > 0")
    if first_purchase is not None:
        bought = bought.where(F.col("first_purchase_date") >= F.lit(first_purchase))
    own_mean = F.round(F.col("total_spent") / F.col("total_purchases"), 4).alias("own_mean")
    spent = bought.select("customer_id", "total_spent", own_mean)
    return (
        customers.select("customer_id", "region", segment)
        .join(spent, "customer_id")
        .groupBy("region", segment)
        .agg(
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("total_spent").alias("total_revenue"),
            F.sum("own_mean").alias("_means"),
        )
        .withColumn("avg_purchase_amount", mean(F.col("_means"), F.col("unique_customers")))
        .drop("_means")
    )


def segmentation_exact(summary: DataFrame, segment: str = "gender") -> DataFrame:
    """Segments with the mean over all their sales, from the stored sums."""
    return (
        summary.where("total_purchases > 0")
        .groupBy("region", segment)
        .agg(
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("total_spent").alias("total_revenue"),
            F.sum("total_purchases").alias("_lines"),
        )
        .withColumn("avg_purchase_amount", mean(F.col("total_revenue"), F.col("_lines")))
        .drop("_lines")
    )


def customers_in_daily_zones(daily: DataFrame, customers: DataFrame) -> DataFrame:
    """Per day and region the customers whose id lies in the day's id range."""
    return count_points_in_zones(
        daily,
        "sale_date",
        "min_customer_id",
        "max_customer_id",
        customers,
        "region",
        "customer_id",
        "customers_in_zone",
    )


def zone_totals(daily: DataFrame, customers: DataFrame) -> DataFrame:
    """Day totals joined to the customers in the day's id range, per day and region.

    Every pair of a day and a customer in range contributes the totals of the
    whole day, so the revenue of a region is the day's revenue times the number
    of its customers in range. It bounds, but is not, the region's revenue.
    """
    zones = customers_in_daily_zones(daily, customers)
    return zones.join(daily, "sale_date").select(
        "sale_date",
        "region",
        F.col("customers_in_zone").alias("total_sales"),
        (F.col("total_revenue").cast("double") * F.col("customers_in_zone")).alias("total_revenue"),
        "avg_sale_amount",
    )


def zone_pruned_daily(
    daily: DataFrame, customers: DataFrame, fact: MonthlyTable, since: dt.date
) -> DataFrame:
    """Sales per day and region since a day, read only for days that can have any.

    A day is skipped when no wanted customer's id lies in its id range, and a
    month without any other day is not opened: the days, a row each, are
    stored, and the scan of the fact takes its months from them. What is read
    is joined to the regions exactly, so the result equals the query without
    the summary.
    """
    zones = count_points_in_zones(
        daily, "sale_date", "min_customer_id", "max_customer_id", customers, None, "customer_id"
    )
    days = stage(zones.select("sale_date"), "days")
    located = fact.read_days(days, since).join(customers.select("customer_id", "region"), "customer_id")
    return daily_by_region(located)
