"""What is not opened: files by index, by curve, and months chosen while a query runs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratoform.catalog import all_queries
from stratoform.operators.fileindex import FileIndex
from stratoform.operators.layout import write_on_curve
from stratoform.sources.partitioned import MonthlyTable

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def files_read(df):
    """Files and partitions that the scans of a query have opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found, waiting = 0, [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            waiting.append(node.plan())
            continue
        if name == "FileSourceScanExec" and node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


# --- file index ------------------------------------------------------------


@pytest.fixture
def scattered(spark, tmp_path):
    """Files whose values are spread, so that smallest and largest ones tell nothing; file k has values of k mod 16."""
    path = f"file://{tmp_path}/scattered"
    df = spark.range(16_000).select(
        (F.col("id") % 16 + 16 * F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("key"),
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("name "), F.col("id").cast("string"))).alias("name"),
        (F.col("id") % 16).cast("int").alias("part"),
    )
    df.repartition(16, "part").write.parquet(path)
    return df, path, FileIndex.build(spark, path, f"file://{tmp_path}/index", ["key", "name"])


def test_only_files_that_can_hold_a_probe_are_read(spark, scattered):
    df, path, index = scattered
    whole = len(spark.read.parquet(path).inputFiles())
    some = [r.key for r in df.orderBy("name").select("key").limit(3).collect()]
    for column, values in (("key", some), ("name", ["name 1", "name 777", "nobody"])):
        probes = spark.createDataFrame([(v,) for v in values], df.select(column).schema)
        found = index.lookup(probes, column)
        assert rows(found) == rows(df.where(F.col(column).isin(values)))
        opened = index.files_with(probes, column)
        holding = {r[0] for r in spark.read.parquet(path).where(F.col(column).isin(values)).select(F.input_file_name()).distinct().collect()}
        assert holding <= set(opened) and len(opened) <= len(holding) + 1 < whole
        assert set(index.read(spark, opened).inputFiles()) == set(opened)


def test_unknown_values_open_almost_nothing(spark, scattered):
    df, path, index = scattered
    unknown = spark.range(300).select((F.col("id") * 16 + 5_000_000).alias("key"))
    within = df.select((F.col("key") * 2 + 1_600_001).alias("key")).limit(5)
    assert index.files_with(unknown, "key") == []
    assert index.lookup(unknown, "key").count() == 0
    assert len(index.files_with(within, "key")) <= 2
    assert index.files_with(unknown.where("key is null"), "key") == []
    assert index.files_with(spark.createDataFrame([(None,)], "key long"), "key") == []


def test_many_probes_take_the_other_way(spark, scattered):
    df, _, index = scattered
    probes = df.select("key").where("part = 3").limit(600)
    assert rows(index.lookup(probes, "key")) == rows(df.join(probes.distinct(), "key", "left_semi"))


def test_new_files_alone_are_indexed(spark, scattered):
    df, path, index = scattered
    assert index.refresh(spark) == 0
    spark.createDataFrame([(-5, "new", 99)], df.schema).coalesce(1).write.mode("append").parquet(path)
    probe = spark.createDataFrame([(-5,)], "key long")
    assert index.files_with(probe, "key") == []
    assert index.refresh(spark) == 1 and index.refresh(spark) == 0
    assert rows(index.lookup(probe, "key"), "name") == [("new",)]
    assert len(index.files_with(probe, "key")) == 1
    assert index.files_between(spark, "key", -10, -1) == index.files_with(probe, "key")


def test_sorted_copies_are_cut_by_their_ends(spark, tmp_path):
    path = f"file://{tmp_path}/sorted"
    spark.range(8_000).select("id", (F.col("id") % 7).alias("n")).repartitionByRange(8, "id").write.parquet(path)
    index = FileIndex.build(spark, path, f"file://{tmp_path}/index", ["id"])
    whole = len(spark.read.parquet(path).inputFiles())
    few = index.files_between(spark, "id", 100, 120)
    assert 1 <= len(few) <= 2 < whole
    assert index.read(spark, few).where("id between 100 and 120").count() == 21


# --- the curve -------------------------------------------------------------


def test_a_range_of_any_column_is_in_few_files(spark, tmp_path):
    rng = random.Random(4)
    data = [(D(2020, 1, 1) + dt.timedelta(days=rng.randrange(1000)), int(rng.paretovariate(0.5)) % 100_000, rng.choice("abcdefghijklmnop") + str(rng.random())) for _ in range(20_000)]
    df = spark.createDataFrame([*data, (None, None, None)], "day date, customer long, product string").repartition(4)
    path, columns = f"file://{tmp_path}/curve", ["day", "customer", "product"]
    write_on_curve(df, path, columns, files=512)
    assert rows(spark.read.parquet(path)) == rows(df)
    index = FileIndex.build(spark, path, f"file://{tmp_path}/index", columns)
    whole = len(spark.read.parquet(path).inputFiles())
    assert whole > 400
    ranges = {"day": (D(2020, 6, 1), D(2020, 6, 20)), "customer": (50, 60), "product": ("d", "d9")}
    for column, (low, high) in ranges.items():
        few = index.files_between(spark, column, low, high)
        test = F.col(column).between(F.lit(low), F.lit(high))
        assert len(few) < whole / 4, column
        assert rows(index.read(spark, few).where(test)) == rows(df.where(test))


def test_a_hot_value_is_in_several_files(spark, tmp_path):
    df = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"), "id")
    write_on_curve(df, f"file://{tmp_path}/hot", ["a", "b"], files=12)
    sizes = [r[1] for r in spark.read.parquet(f"file://{tmp_path}/hot").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 6_000 and max(sizes) < 1_500


# --- months ----------------------------------------------------------------


def test_months_are_chosen_while_the_query_runs(spark, tmp_path):
    days = [D(2023, 1, 1) + dt.timedelta(days=i) for i in range(730)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)] + [(None, -1)], "sale_date date, n int")
    table = MonthlyTable(f"file://{tmp_path}/fact", "sale_date")
    table.write(df, "n")
    assert rows(table.read(spark)) == rows(df)
    assert rows(table.read(spark, D(2023, 5, 20), D(2023, 6, 3)), "n") == sorted([(i,) for i in range(139, 154)], key=repr)
    path = f"file://{tmp_path}/days"
    spark.createDataFrame([(D(2023, 3, 5),), (D(2023, 3, 5),), (D(2024, 7, 1),), (D(2022, 1, 1),), (None,)], "sale_date date").write.parquet(path)
    found = table.read_days(spark.read.parquet(path), D(2023, 2, 1))
    assert rows(found, "sale_date") == [(D(2023, 3, 5),), (D(2024, 7, 1),)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert files_read(found) - files_read(spark.read.parquet(path)) <= 2 < files_read(table.read(spark))


def test_zone_pruned_daily_prunes_by_month(spark, sf_dir):
    found = all_queries()["zone_pruned_daily"].build(spark, sf_dir)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
