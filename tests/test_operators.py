"""Operators against brute force, on data with a hot key."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from plans import physical
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash
from stratoform.operators import distinct
from stratoform.operators.bloom import BloomFilter, sizing
from stratoform.operators.countmin import CountMin
from stratoform.operators.latest import latest_per_key, upsert_latest
from stratoform.operators.layout import RangeCopy, write_sorted
from stratoform.operators.numbering import with_row_numbers
from stratoform.operators.versions import spread_nulls, with_next_start, with_version_in_force
from stratoform.plans.quality import connectivity, orphans
from stratoform.operators.zones import count_points_in_zones

DAY = dt.date(2020, 1, 1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def versions(spark, count=600, seed=1):
    """A third of the rows belong to key 0; some keys and starts are null; days repeat."""
    rng = random.Random(seed)
    data = []
    for i in range(count):
        key = 0 if i % 3 == 0 else rng.choice([*range(1, 40), None])
        start = None if rng.random() < 0.02 else DAY + dt.timedelta(days=rng.randrange(60))
        data.append((key, start, i))
    return spark.createDataFrame(data, "key int, start date, id int").repartition(7)


def test_latest_per_key(spark):
    df = versions(spark)
    got = rows(latest_per_key(df, ["key"], ["start", "id"]))
    best = {}
    for r in df.collect():
        rank = (r["start"] or dt.date.min, r["id"])
        if r["key"] not in best or rank > best[r["key"]][0]:
            best[r["key"]] = (rank, tuple(r))
    assert got == sorted((v[1] for v in best.values()), key=repr)


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = physical(latest_per_key(versions(spark), ["key"], ["start"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_upsert_twice_changes_nothing(spark):
    current = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "key int, at int, v string")
    changes = spark.createDataFrame([(2, 4, "late"), (3, 1, "new"), (1, 2, "newer")], "key int, at int, v string")
    once = upsert_latest(current, changes, ["key"], ["at"])
    expected = [(1, 2, "newer"), (2, 5, "b"), (3, 1, "new")]
    assert rows(once) == expected
    assert rows(upsert_latest(once, changes, ["key"], ["at"])) == expected


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_next_start_equals_lead(spark, kind):
    df = versions(spark)
    if kind == "timestamp":
        df = df.withColumn("start", (F.col("start").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 50)))
    lead = F.lead("start").over(Window.partitionBy("key").orderBy("start", "id"))
    assert rows(with_next_start(df, "key", "start", ["id"])) == rows(df.withColumn("next_start", lead))


@pytest.mark.parametrize("crowd", [(0, DAY), (None, DAY), (0, None)])
def test_next_start_of_a_crowded_day(spark, crowd):
    """A third of the rows share key and day; no window spans them."""
    rng = random.Random(2)
    data = [(*(crowd if i % 3 == 0 else (rng.randrange(9), DAY + dt.timedelta(days=rng.randrange(20)))), i) for i in range(300)]
    df = spark.createDataFrame(data, "key int, start date, id int").repartition(7)
    lead = F.lead("start").over(Window.partitionBy("key").orderBy("start", "id"))
    got = with_next_start(df, "key", "start", ["id"])
    assert rows(got) == rows(df.withColumn("next_start", lead))
    # Over the days of a key only.
    windows = [line for line in physical(got).splitlines() if "Window [" in line]
    assert windows and all("lead(_first" in line for line in windows)


def test_next_start_within_a_second(spark):
    """Instants of a second, seconds of a day, days; a plan only, nothing is written for it."""
    rng = random.Random(3)
    at = lambda: dt.datetime(2024, 10, rng.randrange(26, 29), rng.choice([0, 1, 23]), 0, rng.randrange(2), rng.randrange(3))
    data = [(rng.randrange(3), None if rng.random() < 0.05 else at(), i) for i in range(400)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(data, "key int, start timestamp_ntz, id int").withColumn("start", F.col("start").cast(kind))
        lead = F.lead("start").over(Window.partitionBy("key").orderBy("start", "id"))
        assert rows(with_next_start(df, "key", "start", ["id"])) == rows(df.withColumn("next_start", lead))


def test_rows_alike_in_the_tiebreak_have_the_same_next_start(spark):
    df = spark.createDataFrame([(1, DAY, 5)] * 3 + [(1, DAY + dt.timedelta(days=2), 6)], "key int, start date, id int")
    got = rows(with_next_start(df, "key", "start", ["id"]), "id", "next_start")
    assert got == sorted([(5, DAY + dt.timedelta(days=2))] * 3 + [(6, None)], key=repr)


def test_rows_without_a_key_are_dealt_out(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("key"))
    dimension = spark.range(5).select(F.col("id").alias("key"), F.col("id").alias("name"))
    assert facts.where("key is null").select(spread_nulls(facts, "key")).distinct().count() > 300
    expected = sum(i % 3 == 0 or i % 7 > 4 for i in range(1000))
    assert orphans(facts, "key", dimension, "key").count() == expected
    joined = connectivity(facts, {"key": dimension}, ["id", "key", "name"])
    assert joined.count() == 1000 and joined.where("name is null").count() == expected


def test_version_in_force_equals_brute_force(spark):
    vs = versions(spark, 200)
    rng = random.Random(5)
    data = [
        (i, 0 if i % 3 == 0 else rng.choice([*range(1, 45), None]), DAY + dt.timedelta(days=rng.randrange(-5, 70)))
        for i in range(400)
    ] + [(1000, 0, None)]
    facts = spark.createDataFrame(data, "fact int, key int, on date")
    got = rows(with_version_in_force(facts, vs, "key", "on", "start", ["id"], ["id"]), "fact", "id")
    known = [r for r in vs.collect() if r["key"] is not None and r["start"] is not None]
    expected = []
    for fact, key, on in data:
        valid = [(v["start"], v["id"]) for v in known if on and v["key"] == key and v["start"] <= on]
        expected.append((fact, max(valid)[1] if valid else None))
    assert got == sorted(expected, key=repr)


def test_stored_ends_that_overlap_or_are_open_give_one_version(spark):
    day = lambda m, d=1: dt.date(2020, m, d)
    vs = spark.createDataFrame(
        [(1, day(1), None, "a"), (1, day(2), None, "b"), (2, day(1), day(9), "c"), (2, day(3), day(4), "d"), (3, day(1), day(2), "e")],
        "key int, start date, end date, name string",
    )
    facts = spark.createDataFrame(
        [(1, 1, day(3)), (2, 1, day(1, 15)), (3, 2, day(2)), (4, 2, day(4)), (5, 2, day(5)), (6, 3, day(2)), (7, 3, day(2, 2))],
        "fact int, key int, on date",
    )
    got = with_version_in_force(facts, vs, "key", "on", "start", ["name"], ["name"], end="end")
    expected = [(1, "b"), (2, "a"), (3, "c"), (4, "d"), (5, None), (6, "e"), (7, None)]
    assert rows(got, "fact", "name") == sorted(expected, key=repr)


def test_row_numbers_equal_the_window(spark):
    df = versions(spark, 900).withColumn("tag", F.lit("x"))
    order = ["key", "start", "id"]
    window = F.row_number().over(Window.orderBy(*order))
    numbered = with_row_numbers(df, order, "n")
    expected = df.select(window.cast("bigint").alias("n"), *df.columns)
    assert rows(numbered) == rows(expected)
    assert numbered.columns == ["n", *df.columns]


def test_row_numbers_of_nothing(spark):
    assert with_row_numbers(versions(spark).where("id < 0"), ["id"], "n").count() == 0


def test_zone_counts_equal_the_range_join(spark):
    rng = random.Random(3)
    zones = [(DAY + dt.timedelta(days=i), *sorted((rng.randrange(100), rng.randrange(100)))) for i in range(40)]
    zones += [(DAY + dt.timedelta(days=90), None, None), (DAY + dt.timedelta(days=91), 200, 300)]
    points = [(i, None if i % 17 == 0 else rng.choice("abc")) for i in range(0, 100, 2)]
    z = spark.createDataFrame(zones, "day date, low int, high int")
    p = spark.createDataFrame(points, "id int, team string")
    got = rows(count_points_in_zones(z, "day", "low", "high", p, "team", "id"), "day", "team", "points_in_zone")
    expected = {}
    for day, low, high in zones:
        for i, team in points:
            if low is not None and team is not None and low <= i <= high:
                expected[day, team] = expected.get((day, team), 0) + 1
    assert got == sorted(((*k, v) for k, v in expected.items()), key=repr)


# --- sketches --------------------------------------------------------------


def items(spark, count=2000):
    """Item 0 makes up a third of the rows; some are null."""
    return spark.range(count).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700).alias("item")
    )


def test_bloom_sizing():
    assert sizing(1000) == (9728, 6)
    assert sizing(10_000) == (96256, 6)
    assert sizing(0) == sizing(1) == (512, 6)


@pytest.fixture(params=["shipped", "shuffled"])
def way(request, spark):
    """Both ways in which Spark may run the probe's join; the plan is the same."""
    if request.param == "shipped":
        yield
        return
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("kind", list(Hash))
def test_bloom(spark, way, kind):
    df = items(spark)
    known = BloomFilter.build(df, "item", 700, kind=kind)
    probes = spark.range(10_000).select(F.when(F.col("id") % 11 != 0, F.col("id")).alias("item"))
    marked = known.mark(probes.unionByName(probes), "item")
    answers = marked.where("item is not null").groupBy("item").agg(F.min("might_contain").alias("yes"))
    members = df.select("item").distinct().where("item is not null")
    assert marked.count() == 20_000
    assert marked.where("item is null and might_contain").count() == 0
    assert answers.join(members, "item", "left_semi").where("not yes").count() == 0
    strangers = answers.join(members, "item", "left_anti")
    assert strangers.where("yes").count() < 0.03 * strangers.count()


def test_a_large_filter_has_the_same_plan(spark):
    sizes = [BloomFilter.build(items(spark), "item", n) for n in (100, 20_000_000)]
    operators = [re.findall(r"([A-Z]\w+)[ (]", physical(f.mark(items(spark), "item"))) for f in sizes]
    assert operators[0] == operators[1] and "Generate" in operators[0]
    assert sizes[1].mark(items(spark), "item").where("item is not null and not might_contain").count() == 0


def test_bloom_merge_save_load(spark, tmp_path):
    df = items(spark)
    whole = BloomFilter.build(df, "item", 700)
    parts = [BloomFilter.build(df.where(test), "item", 700) for test in ("item < 300", "item >= 250")]
    merged = parts[0].merge(parts[1])
    assert rows(merged.words) == rows(whole.words)
    merged.save(f"file://{tmp_path}/bloom")
    loaded = BloomFilter.load(spark, f"file://{tmp_path}/bloom")
    assert (loaded.size, loaded.hashes, loaded.kind) == (whole.size, whole.hashes, whole.kind)
    assert rows(loaded.words) == rows(whole.words)
    with pytest.raises(ValueError, match="differ"):
        whole.merge(BloomFilter.build(df, "item", 10))


def test_bloom_of_nothing_contains_nothing(spark):
    empty = BloomFilter.build(items(spark).where("item < 0"), "item", 0)
    assert empty.mark(items(spark), "item").where("might_contain").count() == 0


@pytest.mark.parametrize("kind", list(Hash))
def test_countmin(spark, way, kind):
    df = items(spark)
    sketch = CountMin.build(df, "item", width=100, depth=4, kind=kind)
    counts = df.groupBy("item").agg(F.count("item").alias("actual"))
    estimated = sketch.estimate(counts, "item")
    assert estimated.where("estimate < actual").count() == 0
    assert estimated.where("item is null").first()["estimate"] == 0
    # The error bound e/width holds for each item with high probability.
    too_high = estimated.where(F.col("estimate") > F.col("actual") + 2.72 / 100 * 2000).count()
    assert too_high <= 0.05 * estimated.count()
    unknown = spark.range(10).select((-F.col("id") - 1).alias("item"))
    assert sketch.estimate(unknown, "item").where("estimate < 0").count() == 0


def test_countmin_weights_merge_save_load(spark, tmp_path):
    df = items(spark).withColumn("weight", F.lit(3))
    whole = CountMin.build(df, "item", F.col("weight"))
    parts = [CountMin.build(df.where(t), "item", F.col("weight")) for t in ("item < 300", "item >= 300")]
    merged = parts[0].merge(parts[1])
    assert rows(merged.cells) == rows(whole.cells)
    merged.save(f"file://{tmp_path}/cm")
    loaded = CountMin.load(spark, f"file://{tmp_path}/cm")
    hot = spark.createDataFrame([(0,)], "item int")
    assert loaded.estimate(hot, "item").first()["estimate"] >= 3 * items(spark).where("item = 0").count()


def test_distinct_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("item"), (F.col("id") % 7).alias("part"))
    parts = distinct.sketches(df, F.col("item"), ["part"])
    estimate = distinct.union(parts).select(distinct.estimate()).first()[0]
    assert abs(estimate - 20_000) <= distinct.TOLERANCE * 20_000


def test_column_report_skips_nulls(spark):
    report = distinct.column_report(items(spark).withColumn("none", F.lit(None).cast("int")), ["item", "none"])
    exact = items(spark).select(F.count_distinct("item")).first()[0]
    got = {r["column_name"]: r["actual"] for r in report.collect()}
    assert got == {"item": exact}


# --- layouts ---------------------------------------------------------------


def test_sorted_copy_splits_a_hot_value(spark, tmp_path, request):
    # So small a table would otherwise be joined into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    path = f"file://{tmp_path}/sorted"
    write_sorted(df, path, "k")
    copy = spark.read.parquet(path)
    assert rows(copy) == rows(df)
    files = copy.select(F.input_file_name().alias("file"), "k").where("k = 0").groupBy("file").count()
    assert files.count() > 1


def test_range_copy_is_used_only_when_implied(spark, tmp_path):
    df = spark.range(100).withColumn("day", F.date_add(F.lit(DAY), F.col("id").cast("int")))
    bound = DAY + dt.timedelta(days=50)
    copy = RangeCopy.write(df, f"file://{tmp_path}/recent", "day", bound)
    for days, served in ((60, True), (50, True), (49, False)):
        lower = DAY + dt.timedelta(days=days)
        assert copy.serves(lower) is served
        read = copy.read(df, lower)
        assert read.count() == 100 - days
        assert all("/recent/" in f for f in read.inputFiles()) and bool(read.inputFiles()) is served
    assert copy.read(df, None).count() == 100
