"""Heavy hitters against exact counts."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratoform.operators.frequent import error_share, frequent_sketches, heavy_hitters, united

TRACKED = 256


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows are one item, some items are frequent, most occur once or twice."""
    n = F.col("id")
    item = F.when(n % 3 == 0, F.lit(-1)).when(n % 5 == 0, n % 8).otherwise(F.pmod(F.xxhash64("id"), F.lit(40_000)))
    return spark.range(60_000).select(F.when(n % 100 != 7, item).alias("item"), (n % 9).alias("day")).repartition(7)


def test_every_frequent_item_is_listed_and_its_bounds_hold(rows):
    exact = Counter(r["item"] for r in rows.collect() if r["item"] is not None)
    total = sum(exact.values())
    parts = frequent_sketches(rows, F.col("item"), ["day"], TRACKED)
    share = 2.1 * error_share(TRACKED)
    found = {r["item"]: r for r in heavy_hitters(united(parts, tracked=TRACKED), share, tracked=TRACKED).collect()}
    assert {i for i, k in exact.items() if k >= share * total} <= set(found)
    assert -1 in found and len(found) < 50
    assert all(r["at_least"] <= exact[i] <= r["at_most"] for i, r in found.items())
    assert all(r["at_most"] - r["at_least"] <= error_share(TRACKED) * total for r in found.values())


def test_parts_can_be_asked_alone(rows):
    parts = frequent_sketches(rows, F.col("item"), ["day"], TRACKED)
    days = heavy_hitters(parts.where("day < 2"), 0.05, ["day"], TRACKED)
    exact = Counter((r["day"], r["item"]) for r in rows.where("day < 2 and item is not null").collect())
    for day in (0, 1):
        n = sum(k for (d, _), k in exact.items() if d == day)
        assert {i for (d, i), k in exact.items() if d == day and k >= 0.05 * n} <= {r["item"] for r in days.collect() if r["day"] == day}


def test_few_items_are_exact(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)], "item string")
    found = heavy_hitters(united(frequent_sketches(df, F.col("item"))), 0.1)
    assert {(r["item"], r["at_most"]) for r in found.collect()} == {("a", 5), ("b", 3)}


def test_shares_that_cannot_be_promised_are_refused(spark):
    with pytest.raises(ValueError):
        heavy_hitters(spark.range(0), error_share(TRACKED), tracked=TRACKED)
