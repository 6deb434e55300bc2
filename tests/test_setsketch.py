"""Theta sketches against exact sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stratoform.operators.setsketch import SetOf, combined, set_sketches, tolerance


@pytest.mark.parametrize("log_entries", [6, 12])
def test_combinations_are_within_their_bound(spark, log_entries):
    rng = random.Random(1)
    data = [(rng.randrange(30), rng.randrange(4) == 0, rng.choice([None, *range(6000)])) for _ in range(20_000)]
    df = spark.createDataFrame(data, "day int, high boolean, item int").repartition(5)
    parts = set_sketches(df, F.col("item"), ["day", "high"], log_entries)
    late, high, none = SetOf("late"), SetOf("high"), SetOf("none")
    wanted = {"both": late & high, "late only": late - high, "either": late | high, "late": late, "nothing": late & none, "all but": (late | high) - none}
    found = combined(parts, {"late": F.col("day") >= 20, "high": F.col("high"), "none": F.col("day") > 99}, wanted, log_entries)
    sets = {"late": {i for d, _, i in data if d >= 20} - {None}, "high": {i for _, h, i in data if h} - {None}, "none": set()}
    exact = {
        "both": sets["late"] & sets["high"], "late only": sets["late"] - sets["high"], "either": sets["late"] | sets["high"],
        "late": sets["late"], "nothing": set(), "all but": sets["late"] | sets["high"],
    }
    rows = {r.subset: r for r in found.collect()}
    assert set(rows) == set(exact)
    for name, items in exact.items():
        assert abs(rows[name].estimate - len(items)) <= rows[name].most_off, name
    assert rows["nothing"].estimate == 0
    assert rows["either"].most_off <= 1.3 * tolerance(log_entries) * 6000 + 1


def test_small_sets_are_exact(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", i) for i in range(50, 130)] + [("b", None)], "part string, item int")
    parts = set_sketches(df, F.col("item"), ["part"])
    a, b = SetOf("a"), SetOf("b")
    found = combined(parts, {"a": F.col("part") == "a", "b": F.col("part") == "b"}, {"and": a & b, "not": a - b, "or": a | b})
    assert {r.subset: r.estimate for r in found.collect()} == {"and": 50, "not": 50, "or": 130}


def test_no_parts(spark):
    parts = set_sketches(spark.createDataFrame([], "part string, item int"), F.col("item"), ["part"])
    found = combined(parts, {"a": F.col("part") == "a"}, {"a": SetOf("a"), "twice": SetOf("a") & SetOf("a")})
    assert {r.subset: (r.estimate, r.most_off) for r in found.collect()} == {"a": (0, 0), "twice": (0, 0)}
