"""Sketches of the sales star and reports on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash
from stratoform.functions.text import composite
from stratoform.operators import distinct
from stratoform.operators.bloom import BloomFilter
from stratoform.operators.countmin import CountMin
from stratoform.session import stage


def domain_filter(df: DataFrame, column: str, kind: Hash = Hash.FAST) -> tuple[BloomFilter, int]:
    """Bloom filter over the distinct values of a column, and their number.

    It is sized for twice as many, to leave room for new values. The distinct
    values are stored, as they are read once to count and once to build.
    """
    values = df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    known = stage(values, f"domain-{column}")
    members = known.count()
    return BloomFilter.build(known, "value", 2 * members, kind=kind), members


def prefiltered(
    df: DataFrame, key: str, members: DataFrame, member_key: str, filter_: BloomFilter
) -> DataFrame:
    """Rows whose key is among the members: the Bloom filter's blocks first, then the exact semi join."""
    rows = filter_.mark(df, key, "_maybe").where("_maybe").drop("_maybe")
    wanted = members.select(F.col(member_key).alias("_member"))
    return rows.join(wanted, rows[key] == wanted["_member"], "left_semi")


def pair_sketch(sales: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Distinct-count sketch of (customer, product) pairs."""
    both = F.when(
        F.col("customer_id").isNotNull() & F.col("product_id").isNotNull(),
        composite(F.col("customer_id"), F.col("product_id")),
    )
    return distinct.sketches(sales, both, by)


def subset_sketches(sales: DataFrame, threshold: int) -> DataFrame:
    """Customer sketches per day and value class; subsets are unions of some of them."""
    return distinct.sketches(
        sales, F.col("customer_id"), ["sale_date", (F.col("net_amount") > threshold).alias("high_value")]
    )


def subset_estimates(parts: DataFrame, subsets: Mapping[str, Column]) -> DataFrame:
    """Rows ``(subset, estimate)`` from stored sketches, without the sales."""
    estimates = [
        distinct.union(parts.where(test)).select(
            F.lit(name).alias("subset"), distinct.estimate().alias("estimate")
        )
        for name, test in subsets.items()
    ]
    return reduce(DataFrame.unionByName, estimates)


def valid_targets(
    targets: DataFrame, key: str, members: BloomFilter, frequencies: CountMin
) -> DataFrame:
    """Targets that the filter may contain and the sketch has seen."""
    marked = members.mark(targets.select(key).distinct(), key, "_member")
    seen = frequencies.estimate(marked.where("_member"), key, "_frequency")
    return seen.where("_frequency > 0").select(key)


def pair_accuracy(
    valid_customers: DataFrame, valid_products: DataFrame, exact_pairs: DataFrame
) -> DataFrame:
    """How well "both ids are valid" predicts that the customer bought the product.

    The predicted pairs are all combinations of the valid ids. Their number is
    a product and the hits are the exact pairs with both ids valid, so the
    combinations are not built. Ratios without a denominator are null. All
    three inputs are used more than once and therefore stored first.
    """
    valid_customers = stage(valid_customers, "valid-customers")
    valid_products = stage(valid_products, "valid-products")
    exact_pairs = stage(exact_pairs, "exact-pairs")
    hits = exact_pairs.join(valid_customers, "customer_id", "left_semi").join(
        valid_products, "product_id", "left_semi"
    )
    counts = {
        "valid_customers": valid_customers,
        "valid_products": valid_products,
        "exact_pairs": exact_pairs,
        "true_positives": hits,
    }
    named = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
            for name, df in counts.items()
        ],
    )
    one_row = named.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in counts])
    return one_row.withColumn(
        "estimated_pairs", F.col("valid_customers") * F.col("valid_products")
    ).select(
        *counts,
        "estimated_pairs",
        F.round(F.try_divide(F.col("true_positives").cast("double"), "exact_pairs"), 6).alias("recall"),
        F.round(F.try_divide(F.col("true_positives").cast("double"), "estimated_pairs"), 6).alias("precision"),
    )


_ITEM_REPORT = ("structure", "column_name", "item", "estimate", "actual", "error_rate")


def frequency_report(sketch: CountMin, actual: DataFrame, column: str, count: str) -> DataFrame:
    """Estimate, actual count and error of each item of ``actual``."""
    items = sketch.estimate(actual.select(F.col(column).alias("item"), F.col(count).alias("actual")), "item")
    return items.select(
        F.lit("count_min").alias("structure"),
        F.lit(column).alias("column_name"),
        F.col("item").cast("string").alias("item"),
        F.col("estimate").cast("bigint").alias("estimate"),
        "actual",
        distinct.error_rate(F.col("estimate"), F.col("actual")).alias("error_rate"),
    )


def membership_report(filter_: BloomFilter, probes: DataFrame, column: str, actual: str) -> DataFrame:
    """Answer (1 or 0) and truth of each probe; the error is 1 for a false positive."""
    marked = filter_.mark(probes.select(F.col(column).alias("item"), F.col(actual).alias("truth")), "item", "answer")
    estimate, truth = F.col("answer").cast("bigint"), F.col("truth").cast("bigint")
    return marked.select(
        F.lit("bloom").alias("structure"),
        F.lit(column).alias("column_name"),
        F.col("item").cast("string").alias("item"),
        estimate.alias("estimate"),
        truth.alias("actual"),
        distinct.error_rate(estimate, truth).alias("error_rate"),
    )


def distinct_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return distinct.column_report(df, columns).select(
        F.lit("hyperloglog").alias("structure"),
        "column_name",
        F.lit(None).cast("string").alias("item"),
        "estimate",
        "actual",
        "error_rate",
    )


def accuracy_report(parts: Sequence[DataFrame]) -> DataFrame:
    """All structures in one table of estimates against actual values."""
    return reduce(DataFrame.unionByName, [p.select(*_ITEM_REPORT) for p in parts])


def accuracy_summary(report: DataFrame, tolerance: float = distinct.TOLERANCE) -> DataFrame:
    """Per structure and column the items checked and those that break its guarantee.

    A Bloom filter and a Count-Min sketch must never answer too low. A
    distinct count must lie within ``tolerance``.
    """
    broken = F.when(
        F.col("structure") == "hyperloglog", F.col("error_rate") > tolerance
    ).otherwise(F.col("estimate") < F.col("actual"))
    return report.groupBy("structure", "column_name").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("actual").alias("actual_total"),
        F.count_if(broken).alias("violations"),
    )


def size_report(
    filters: Mapping[str, BloomFilter],
    counters: Mapping[str, CountMin],
    distinct_columns: Sequence[str],
    raw: Mapping[str, DataFrame],
    log_registers: int = distinct.LOG_REGISTERS,
) -> DataFrame:
    """Bytes of each structure, as built, next to the bytes of the column it summarises.

    ``raw`` gives the column as a one-column table per name.
    """

    def total(df: DataFrame) -> Column:
        size = F.sum(F.octet_length(F.col(df.columns[0]).cast("string")))
        return df.agg(F.coalesce(size, F.lit(0)).cast("bigint").alias("raw_bytes")).scalar()

    def measured(structure: str, column: str, size: DataFrame) -> DataFrame:
        name = F.lit(column).alias("column_name")
        own = F.col("sketch_bytes").cast("bigint")
        return size.select(F.lit(structure).alias("structure"), name, own, total(raw[column]).alias("raw_bytes"))

    sizes = [measured("bloom", c, f.measured_bytes()) for c, f in filters.items()]
    sizes += [measured("count_min", c, s.measured_bytes()) for c, s in counters.items()]
    for column in distinct_columns:
        built = raw[column].agg(F.hll_sketch_agg(raw[column].columns[0], log_registers).alias("sketch"))
        sizes.append(measured("hyperloglog", column, built.select(F.octet_length("sketch").alias("sketch_bytes"))))

    ratio = F.try_divide(F.col("raw_bytes").cast("double"), F.col("sketch_bytes"))
    return reduce(DataFrame.unionByName, sizes).withColumn("ratio", ratio)
