"""Bloom filters, distinct-count and Count-Min sketches.

The queries use the portable hash, so bits, counters and estimates can be
recomputed exactly in SQL. The distinct-count sketch is Spark's own; its
queries show the exact count and whether the estimate is within tolerance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.analytics import (
    customer_product_pairs,
    subsets,
    subsets_sql,
    target_customers,
    target_products,
    unknown_ids,
)
from stratoform.catalog.registry import SINCE, query
from stratoform.catalog.sql import (
    bloom_parameters,
    bloom_positions,
    countmin_cells,
    countmin_estimates,
    tables,
    with_tables,
)
from stratoform.functions.hashing import Hash
from stratoform.model import views
from stratoform.operators import distinct, frequent, setsketch
from stratoform.operators.bloom import BloomFilter
from stratoform.operators.countmin import CountMin
from stratoform.operators.setsketch import SetOf
from stratoform.plans import sales as sales_plans
from stratoform.plans import sketches as plans
from stratoform.session import stage

PORTABLE = Hash.PORTABLE


def key_filter(df: DataFrame, key: str, kind: Hash = PORTABLE) -> BloomFilter:
    """Filter over a key column, sized by the number of its rows."""
    return BloomFilter.build(df, key, df.count(), kind=kind)


# --- Bloom filters ---------------------------------------------------------

_TARGETS = "SELECT c_custkey AS customer_id FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"
_WORDS = """
    SELECT word, CAST(CASE WHEN bits >= 9223372036854775808 THEN bits - 18446744073709551616 ELSE bits END AS BIGINT)
           AS bits
    FROM (SELECT pos // 64 AS word, sum(CAST(pow(2, pos % 64) AS HUGEINT)) AS bits
          FROM (SELECT DISTINCT pos FROM positions) GROUP BY 1)"""


@query(
    "bloom_build",
    f"""WITH targets AS ({_TARGETS}), parameters AS ({bloom_parameters("targets")}),
             positions AS ({bloom_positions("targets", "customer_id", "parameters")}) {_WORDS}""",
)
def bloom_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_filter(target_customers(spark, sf_dir), "customer_id").words


@query(
    "bloom_probe",
    f"""WITH targets AS ({_TARGETS}), parameters AS ({bloom_parameters("targets")}),
             bits AS (SELECT DISTINCT pos FROM ({bloom_positions("targets", "customer_id", "parameters")})),
             probes AS ({bloom_positions("customer", "c_custkey", "parameters")})
        SELECT item AS customer_id, item IN (SELECT customer_id FROM targets) AS is_member,
               bool_and(pos IN (SELECT pos FROM bits)) AS might_contain
        FROM probes GROUP BY item""",
)
def bloom_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.dim_customers(spark, sf_dir).select(
        "customer_id", (F.col("gender") == "AUTOMOBILE").alias("is_member")
    )
    return key_filter(target_customers(spark, sf_dir), "customer_id").mark(customers, "customer_id")


@query(
    "bloom_prefilter_join",
    with_tables(
        f"""SELECT customer_id, count(*) AS total_sales, CAST(sum(net_amount) AS DOUBLE) AS total_revenue
            FROM recent WHERE customer_id IN ({_TARGETS}) GROUP BY customer_id""",
        "recent",
    ),
)
def bloom_prefilter_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the target customers; the sale headers are filtered while scanned."""
    targets = target_customers(spark, sf_dir)
    members = key_filter(targets, "customer_id", Hash.FAST).stored()
    headers = plans.prefiltered(views.buyers(spark, sf_dir), "customer_id", targets, "customer_id", members)
    recent = sales_plans.since(views.sales(spark, sf_dir), SINCE)
    return views.totals_of_buyers(recent, headers).select(
        "customer_id", F.col("lines").alias("total_sales"), F.col("net").alias("total_revenue")
    )


def _domain_words(name: str) -> str:
    return f"""
        SELECT '{name}' AS domain, (SELECT m FROM {name}_parameters) AS bits,
               CAST((SELECT k FROM {name}_parameters) AS INTEGER) AS hashes,
               (SELECT count(*) FROM {name}_values) AS members,
               (SELECT count(DISTINCT pos) FROM ({bloom_positions(f"{name}_values", "v", f"{name}_parameters")})) AS set_bits"""


def _domain_ctes(name: str, values: str) -> str:
    doubled = f"(SELECT v FROM {name}_values UNION ALL SELECT v FROM {name}_values)"
    return f"{name}_values AS ({values}), {name}_parameters AS ({bloom_parameters(doubled)})"


_DOMAINS = {
    "regions": "SELECT DISTINCT region AS v FROM customers",
    "categories": "SELECT DISTINCT category_name AS v FROM products",
    "dates": "SELECT DISTINCT strftime(sale_date, '%Y-%m-%d') AS v FROM sales",
}


@query(
    "bloom_domains",
    tables("customers", "products", "sales")
    + ", "
    + ", ".join(_domain_ctes(n, v) for n, v in _DOMAINS.items())
    + " UNION ALL ".join(_domain_words(n) for n in _DOMAINS),
)
def bloom_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters over the values that queries commonly filter by."""
    domains = {
        "regions": (views.dim_customers(spark, sf_dir), "region"),
        "categories": (views.dim_products(spark, sf_dir), "category_name"),
        "dates": (views.sales(spark, sf_dir), "sale_date"),
    }
    rows = None
    for name, (df, column) in domains.items():
        built, members = plans.domain_filter(df, column, PORTABLE)
        row = built.words.agg(F.sum(F.bit_count("bits")).alias("set_bits")).select(
            F.lit(name).alias("domain"),
            F.lit(built.size).cast("bigint").alias("bits"),
            F.lit(built.hashes).alias("hashes"),
            F.lit(members).cast("bigint").alias("members"),
            "set_bits",
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


# --- distinct counts -------------------------------------------------------


def within(estimate: Column, actual: Column) -> Column:
    return (distinct.error_rate(estimate, actual) <= distinct.TOLERANCE).alias("within_tolerance")


@query("hll_estimate", "SELECT count(DISTINCT o_custkey) AS actual, true AS within_tolerance FROM orders")
def hll_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = views.buyers(spark, sf_dir).agg(
        distinct.estimate(F.hll_sketch_agg("customer_id", distinct.LOG_REGISTERS)).alias("estimate"),
        F.count_distinct("customer_id").alias("actual"),
    )
    return both.select("actual", within(F.col("estimate"), F.col("actual")))


@query(
    "hll_accuracy",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS actual, true AS within_tolerance FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey")
    ),
)
def hll_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = distinct.column_report(
        views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"]
    )
    return report.select("column_name", "actual", within(F.col("estimate"), F.col("actual")))


@query(
    "hll_pairs",
    with_tables(
        """SELECT count(*) AS actual, true AS within_tolerance
           FROM (SELECT DISTINCT customer_id, product_id FROM sales)""",
        "sales",
    ),
)
def hll_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales_with_customer(spark, sf_dir)
    estimate = plans.pair_sketch(sales).select(distinct.estimate().alias("estimate")).scalar()
    pairs = sales.select("customer_id", "product_id").distinct().agg(F.count(F.lit(1)).alias("actual"))
    return pairs.select("actual", within(estimate, F.col("actual")))


@query("hll_by_day_union", subsets_sql("count(DISTINCT customer_id) AS actual, true AS within_tolerance"))
def hll_by_day_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subset estimates from one stored sketch per day and value class."""
    sales = views.sales_with_customer(spark, sf_dir)
    parts = stage(plans.subset_sketches(sales, 100_000), "customer-sketches")
    in_sketch = {**subsets(), "high value": F.col("high_value")}
    estimates = plans.subset_estimates(parts, in_sketch)
    actual = sales_plans.distinct_customers(sales, subsets()).withColumnRenamed("customers", "actual")
    return estimates.join(actual, "subset").select("subset", "actual", within(F.col("estimate"), F.col("actual")))


# --- sets ------------------------------------------------------------------

#: Wanted combination, and the test of a customer's two flags that says the same.
_COMBINED = {
    "recent and high value": (SetOf("recent") & SetOf("high value"), "recent AND high"),
    "recent without high value": (SetOf("recent") - SetOf("high value"), "recent AND NOT high"),
    "high value without recent": (SetOf("high value") - SetOf("recent"), "high AND NOT recent"),
    "recent or high value": (SetOf("recent") | SetOf("high value"), "recent OR high"),
}


@query(
    "theta_combinations",
    tables("sales")
    + """, flags AS (SELECT customer_id, bool_or(sale_date >= DATE '1998-01-01') AS recent, bool_or(net_amount > 100000) AS high
                     FROM sales GROUP BY customer_id)
    """
    + " UNION ALL ".join(
        f"SELECT '{name}' AS subset, CAST(count_if({test}) AS BIGINT) AS actual, true AS within_bound FROM flags"
        for name, (_, test) in _COMBINED.items()
    ),
)
def theta_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in both of two subsets, and in one without the other, from one sketch per day and value class."""
    sales = views.sales_with_customer(spark, sf_dir)
    recent, high = F.col("sale_date") >= F.lit(SINCE), F.col("net_amount") > 100_000
    parts = setsketch.set_sketches(sales, F.col("customer_id"), ["sale_date", high.alias("high_value")])
    estimates = setsketch.combined(
        stage(parts, "customer-sets"),
        {"recent": recent, "high value": F.col("high_value")},
        {name: wanted for name, (wanted, _) in _COMBINED.items()},
    )
    flags = sales.groupBy("customer_id").agg(F.bool_or(recent).alias("recent"), F.bool_or(high).alias("high"))
    counted = flags.agg(*[F.count_if(F.expr(test)).alias(name) for name, (_, test) in _COMBINED.items()])
    pairs = [F.struct(F.lit(name).alias("subset"), F.col(f"`{name}`").alias("actual")) for name in _COMBINED]
    actual = counted.select(F.inline(F.array(*pairs)))
    off = F.abs(F.col("estimate") - F.col("actual")) <= F.col("most_off")
    return estimates.join(actual, "subset").select("subset", "actual", off.alias("within_bound"))


# --- frequent items --------------------------------------------------------

#: In ten-thousandths of the lines.
_HEAVY = 7


def _heavy_sql(kind: str) -> str:
    return f"""SELECT '{kind}' AS kind, {kind}_id AS item, count(*) AS actual, true AS bounds_hold FROM sales
               GROUP BY {kind}_id HAVING count(*) * 10000 >= {_HEAVY} * (SELECT count(*) FROM sales)"""


@query("heavy_hitters", with_tables(f"{_heavy_sql('customer')} UNION ALL {_heavy_sql('product')}", "sales"))
def heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and products with many lines, listed from one sketch per day, and whether their bounds hold."""
    sales = views.sales_with_customer(spark, sf_dir)
    shown = []
    for kind in ("customer", "product"):
        item = F.col(f"{kind}_id")
        parts = stage(frequent.frequent_sketches(sales, item, ["sale_date"]), f"frequent-{kind}")
        listed = frequent.heavy_hitters(frequent.united(parts), _HEAVY / 10_000)
        counts = sales.groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("actual"))
        lines = parts.select(F.sum("n")).scalar()
        counts = counts.where(F.col("actual") * 10_000 >= F.lit(_HEAVY) * lines)
        hold = F.col("actual").between(F.col("at_least"), F.col("at_most"))
        met = counts.join(listed, "item", "left")
        shown.append(met.select(F.lit(kind).alias("kind"), "item", "actual", F.coalesce(hold, F.lit(False)).alias("bounds_hold")))
    return shown[0].unionByName(shown[1])


# --- Count-Min -------------------------------------------------------------


@query("cms_build", countmin_cells("orders", "o_custkey"))
def cms_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CountMin.build(views.buyers(spark, sf_dir), "customer_id", kind=PORTABLE).cells


def _frequencies(items: str, item: str) -> str:
    return f"""cells AS ({countmin_cells(items, item)}),
                    estimates AS ({countmin_estimates(items, item, "cells")}),
                    counts AS (SELECT {item} AS item, count(*) AS actual FROM {items} GROUP BY 1)
               SELECT item, estimate, actual, round((estimate - actual) / actual, 6) AS error_rate
               FROM estimates JOIN counts USING (item)"""


def _estimated(df: DataFrame, column: str, sketch: CountMin) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("item")).agg(F.count(F.lit(1)).alias("actual"))
    report = sketch.estimate(counts, "item")
    error = (F.col("estimate") - F.col("actual")) / F.col("actual")
    return report.select("item", "estimate", "actual", F.round(error, 6).alias("error_rate"))


@query("cms_estimate", f"WITH {_frequencies('orders', 'o_custkey')}")
def cms_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = views.buyers(spark, sf_dir)
    return _estimated(buyers, "customer_id", CountMin.build(buyers, "customer_id", kind=PORTABLE))


@query(
    "cms_customers",
    f"{tables('sales')}, {_frequencies('sales', 'customer_id')}",
)
def cms_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase frequencies: a sale's lines are counted first and weigh on its buyer."""
    lines = sales_plans.totals(views.sales(spark, sf_dir), "sale_id").select("sale_id", "lines")
    weighted = lines.join(views.buyers(spark, sf_dir), "sale_id")
    sketch = CountMin.build(weighted, "customer_id", F.col("lines"), kind=PORTABLE)
    counts = weighted.groupBy(F.col("customer_id").alias("item")).agg(F.sum("lines").alias("actual"))
    error = (F.col("estimate") - F.col("actual")) / F.col("actual")
    return sketch.estimate(counts, "item").select(
        "item", "estimate", "actual", F.round(error, 6).alias("error_rate")
    )


@query("cms_products", f"WITH {_frequencies('lineitem', 'l_partkey')}")
def cms_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales(spark, sf_dir)
    return _estimated(sales, "product_id", CountMin.build(sales, "product_id", kind=PORTABLE))


# --- combined and reports --------------------------------------------------


def _valid(name: str, members: str, member: str, sold: str, targets: str) -> str:
    """CTEs for the targets that pass the filter of all members and were sold at all."""
    return f"""
        {name}_targets AS ({targets}),
        {name}_members AS (SELECT {member} AS v FROM {members}),
        {name}_parameters AS ({bloom_parameters(f"{name}_members")}),
        {name}_bits AS (SELECT DISTINCT pos FROM ({bloom_positions(f"{name}_members", "v", f"{name}_parameters")})),
        {name}_marked AS (SELECT item FROM ({bloom_positions(f"{name}_targets", "v", f"{name}_parameters")})
                          GROUP BY item HAVING bool_and(pos IN (SELECT pos FROM {name}_bits))),
        {name}_cells AS ({countmin_cells("sales", sold)}),
        {name}_valid AS (SELECT item FROM ({countmin_estimates(f"{name}_marked", "item", f"{name}_cells")})
                         WHERE estimate > 0)"""


def _with_unknown(known: str, key: str) -> str:
    return f"SELECT {key} AS v FROM ({known}) UNION SELECT -{key} - 1 FROM ({known})"


_PRODUCTS = "SELECT p_partkey AS product_id FROM part WHERE p_brand = 'Brand#5'"


@query(
    "pair_estimate_accuracy",
    tables("sales")
    + ","
    + _valid("c", "customer", "c_custkey", "customer_id", _with_unknown(_TARGETS, "customer_id"))
    + ","
    + _valid("p", "part", "p_partkey", "product_id", _with_unknown(_PRODUCTS, "product_id"))
    + f""",
        exact AS (SELECT DISTINCT customer_id, product_id FROM sales
                  WHERE customer_id IN ({_TARGETS}) AND product_id IN ({_PRODUCTS})),
        n AS (SELECT (SELECT count(*) FROM c_valid) AS valid_customers,
                     (SELECT count(*) FROM p_valid) AS valid_products,
                     (SELECT count(*) FROM exact) AS exact_pairs,
                     (SELECT count(*) FROM exact WHERE customer_id IN (SELECT item FROM c_valid)
                             AND product_id IN (SELECT item FROM p_valid)) AS true_positives)
        SELECT *, valid_customers * valid_products AS estimated_pairs,
               round(true_positives / exact_pairs, 6) AS recall,
               round(true_positives / (valid_customers * valid_products), 6) AS precision
        FROM n""",
)
def pair_estimate_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted customers and products, half of them unknown, screened by sketches and scored."""
    sales, buyers = views.sales(spark, sf_dir), views.buyers(spark, sf_dir)
    customers, products = target_customers(spark, sf_dir), target_products(spark, sf_dir)
    lines = sales_plans.totals(sales, "sale_id").select("sale_id", "lines").join(buyers, "sale_id")
    valid_customers = plans.valid_targets(
        customers.unionByName(unknown_ids(customers, "customer_id")),
        "customer_id",
        key_filter(views.dim_customers(spark, sf_dir), "customer_id"),
        CountMin.build(lines, "customer_id", F.col("lines"), kind=PORTABLE),
    )
    valid_products = plans.valid_targets(
        products.unionByName(unknown_ids(products, "product_id")),
        "product_id",
        key_filter(views.dim_products(spark, sf_dir), "product_id"),
        CountMin.build(sales, "product_id", kind=PORTABLE),
    )
    return plans.pair_accuracy(valid_customers, valid_products, customer_product_pairs(spark, sf_dir))


@query(
    "sketch_accuracy",
    """SELECT 'bloom' AS structure, 'customer_id' AS column_name, count(*) AS items,
              CAST(count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS BIGINT) AS actual_total, 0 AS violations FROM customer
       UNION ALL SELECT 'count_min', 'customer_id', count(DISTINCT o_custkey), count(*), 0 FROM orders
       UNION ALL SELECT 'count_min', 'product_id', count(DISTINCT l_partkey), count(*), 0 FROM lineitem
       UNION ALL SELECT 'hyperloglog', 'l_orderkey', 1, count(DISTINCT l_orderkey), 0 FROM lineitem
       UNION ALL SELECT 'hyperloglog', 'l_partkey', 1, count(DISTINCT l_partkey), 0 FROM lineitem""",
)
def sketch_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All structures against exact answers: items checked and guarantees broken."""
    return plans.accuracy_summary(accuracy_detail(spark, sf_dir))


def accuracy_detail(spark: SparkSession, sf_dir: str, kind: Hash = Hash.FAST) -> DataFrame:
    customers, buyers = views.dim_customers(spark, sf_dir), views.buyers(spark, sf_dir)
    sales, targets = views.sales(spark, sf_dir), target_customers(spark, sf_dir)

    def counted(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias("actual"))

    probes = customers.select("customer_id", (F.col("gender") == "AUTOMOBILE").alias("truth"))
    members = BloomFilter.build(targets, "customer_id", targets.count(), kind=kind)
    parts = [
        plans.membership_report(members, probes, "customer_id", "truth"),
        plans.distinct_report(views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"]),
    ]
    for df, column in ((buyers, "customer_id"), (sales, "product_id")):
        sketch = CountMin.build(df, column, kind=kind)
        parts.append(plans.frequency_report(sketch, counted(df, column), column, "actual"))
    return plans.accuracy_report(parts)


_DISTINCT = " UNION ALL ".join(
    f"""SELECT 'hyperloglog', '{c}', NULL, NULL, count(DISTINCT {c}), NULL, TRUE FROM lineitem"""
    for c in ("l_orderkey", "l_partkey")
)


def _counted_sql(items: str, item: str, column: str, name: str) -> str:
    return f"""
        SELECT 'count_min', '{column}', CAST(item AS VARCHAR), estimate, actual,
               CAST(abs(estimate - actual) AS DOUBLE) / greatest(actual, 1), TRUE
        FROM {name}_estimates JOIN (SELECT {item} AS item, count(*) AS actual FROM {items} GROUP BY 1) USING (item)"""


@query(
    "sketch_accuracy_detail",
    f"""WITH targets AS ({_TARGETS}), parameters AS ({bloom_parameters("targets")}),
             bits AS (SELECT DISTINCT pos FROM ({bloom_positions("targets", "customer_id", "parameters")})),
             probes AS ({bloom_positions("customer", "c_custkey", "parameters")}),
             marked AS (SELECT item, CAST(bool_and(pos IN (SELECT pos FROM bits)) AS BIGINT) AS estimate,
                               CAST(item IN (SELECT customer_id FROM targets) AS BIGINT) AS actual
                        FROM probes GROUP BY item),
             o_cells AS ({countmin_cells("orders", "o_custkey")}),
             o_estimates AS ({countmin_estimates("orders", "o_custkey", "o_cells")}),
             l_cells AS ({countmin_cells("lineitem", "l_partkey")}),
             l_estimates AS ({countmin_estimates("lineitem", "l_partkey", "l_cells")})
        SELECT 'bloom' AS structure, 'customer_id' AS column_name, CAST(item AS VARCHAR) AS item, estimate, actual,
               CAST(abs(estimate - actual) AS DOUBLE) / greatest(actual, 1) AS error_rate, TRUE AS within
        FROM marked
        UNION ALL {_counted_sql("orders", "o_custkey", "customer_id", "o")}
        UNION ALL {_counted_sql("lineitem", "l_partkey", "product_id", "l")}
        UNION ALL {_DISTINCT}""",
)
def sketch_accuracy_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate against actual value per structure and item.

    The library's own distinct count is shown as within its tolerance or not.
    """
    detail = accuracy_detail(spark, sf_dir, PORTABLE)
    own = F.col("structure") != "hyperloglog"
    shown = {c: F.when(own, F.col(c)) for c in ("estimate", "error_rate")}
    return detail.withColumn("within", own | (F.col("error_rate") <= distinct.TOLERANCE)).withColumns(shown)


@query(
    "sketch_sizes",
    f"""WITH parameters AS ({bloom_parameters("customer")}),
             raw AS (SELECT 'customer_id' AS column_name,
                            CAST(sum(length(CAST(o_custkey AS VARCHAR))) AS BIGINT) AS raw_bytes FROM orders),
             words AS (SELECT count(DISTINCT pos // 64) AS n FROM ({bloom_positions("customer", "c_custkey", "parameters")})),
             cells AS (SELECT count(*) AS n FROM ({countmin_cells("orders", "o_custkey")})),
             sized AS (SELECT 'bloom' AS structure, n * 8 AS sketch_bytes FROM words
                       UNION ALL SELECT 'count_min', n * 8 FROM cells)
        SELECT structure, column_name, sketch_bytes, raw_bytes, CAST(raw_bytes AS DOUBLE) / sketch_bytes AS ratio,
               TRUE AS plausible FROM sized, raw
        UNION ALL SELECT 'hyperloglog', column_name, NULL, raw_bytes, NULL, TRUE FROM raw""",
)
def sketch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of built structures; the library's own sketch has a header, so its bytes are shown as plausible or not."""
    buyers = views.buyers(spark, sf_dir)
    report = plans.size_report(
        {"customer_id": key_filter(views.dim_customers(spark, sf_dir), "customer_id")},
        {"customer_id": CountMin.build(buyers, "customer_id", kind=PORTABLE)},
        ["customer_id"],
        {"customer_id": buyers.select("customer_id")},
    )
    own = F.col("structure") != "hyperloglog"
    plausible = own | F.col("sketch_bytes").between(8, 2 * (1 << distinct.LOG_REGISTERS))
    shown = {c: F.when(own, F.col(c)) for c in ("sketch_bytes", "ratio")}
    return report.withColumn("plausible", plausible).withColumns(shown)
