"""Hard negatives against brute force and SQL, the pruning bounds, and odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from stratoform.llm import negatives, queries
from stratoform.llm.sql import SQL

SCHEMA = "vec_id long, label int, embedding array<float>, score string, row int, block string"


def table(spark, rows, partitions=4):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return df.repartition(partitions) if rows else df


def mined(df, **options):
    return negatives.mine(
        df, F.col("vec_id") % 10 == 0, F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"), **options
    )


def brute(rows):
    part = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        part.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    dot = lambda u, v: sum(a * b for a, b in zip(u, v))  # noqa: E731, B905
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    out = Counter()
    for i, (anchor, label, a) in enumerate(part):
        if anchor is None or anchor % 10:
            continue
        good = sorted(((dot(a, v), d) for j, (d, own, v) in enumerate(part) if own == label and i != j), key=order)[:5]
        bad = sorted(((dot(a, v), d) for d, own, v in part if own != label), key=order)
        for p, positive in good:
            near = [h for h in bad if 80 * p <= 100 * h[0] <= 100 * p][:5]
            out.update((anchor, positive, r, d, p, s) for r, (s, d) in enumerate(near, 1))
    return out


def collected(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in df.select(names).collect())


def vectors(rng, n=400, dims=8, labels=4):
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        scale = rng.choice([0.1, 1, 1, 3])
        rows.append((i, label, [scale * (c + rng.gauss(0, 0.7)) for c in centers[label]]))
    return rows


@pytest.mark.parametrize("block", [negatives.BLOCK, 20])
def test_matches_brute_force(spark, block):
    rows = vectors(random.Random(1))
    assert collected(mined(table(spark, rows), block=block)) == brute(rows)


def test_odd_rows_ties_and_a_hot_vector(spark):
    rng = random.Random(2)
    rows = vectors(rng, 150, 3)
    rows += [(500 + i, 1, [1.0, 1.0, 0.0]) for i in range(120)]  # a third is one vector
    rows += [(700 + i, 2, [1.0, 1.0, 0.0]) for i in range(60)]
    rows += [(10, 1, [1.0, 1.0, 0.0])] * 2 + [(20, 3, [0.0, 0.0, 0.0]), (21, 3, [0.0, 0.0, 0.0]), (30, 3, [])]
    rows += [(None, 2, [1.0, 1.0, 0.0]), (None, 1, [2.0, 0.0, 1.0]), (40, None, [1.0] * 3), (50, 1, None)]
    rows += [(60, 1, [1.0, None, 2.0]), (70, 1, [1.0, math.nan, 2.0]), (80, 1, [math.inf, 0.0, 0.0]), (90, 1, [1.0, 2.0]), (91, 1, [1.0] * 5)]
    rows += [(110, 9, [-3.0, -2.0, -1.0]), (111, 9, [3.0, 2.0, 1.0]), (120, 77, [1.0, 0.0, 0.0])]
    for block in (negatives.BLOCK, 16):
        assert collected(mined(table(spark, rows), block=block)) == brute(rows)


def test_vectors_too_long_for_whole_numbers_take_no_part(spark):
    rows = vectors(random.Random(3), 60, 3)
    huge = [(200, 1, [3e38, 0.0, 0.0]), (201, 1, [1e8, 0.0, 0.0])]
    assert collected(mined(table(spark, rows + huge))) == brute(rows)
    large = [(210, 1, [2e6, 1.0, 0.0]), (211, 1, [2e6, 0.5, 0.0]), (212, 2, [1.9e6, 0.0, 1.0])]
    assert collected(mined(table(spark, rows + large))) == brute(rows + large)


def test_several_chunks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK", 7)
    rows = vectors(random.Random(5), 300)
    assert collected(mined(table(spark, rows), block=40)) == brute(rows)


def test_no_rows_and_no_anchors(spark):
    assert mined(table(spark, [])).count() == 0
    assert mined(table(spark, [(1, 1, [1.0]), (2, 2, [1.0])])).count() == 0
    assert mined(table(spark, [(10, 1, [1.0]), (12, 2, [1.0])])).count() == 0


def test_ranges_leave_out_no_vector_that_reaches_the_threshold():
    rng = np.random.default_rng(4)
    v = np.floor(rng.normal(0, 20, (500, 16))).astype(np.int64)
    v[np.arange(500), rng.integers(0, 16, 500)] += 300
    norms = np.sqrt((v * v).sum(axis=1))
    order = np.argsort(negatives._shares(v), axis=0, kind="stable").T.astype(np.uint32)
    ids = np.arange(500, dtype=np.int64)
    block = negatives.Block(float(norms.max()), ids.tobytes(), ids.tobytes(), 16, v.tobytes(), order.tobytes())
    spared = 0
    for i in range(60):
        scores = v @ v[i]
        for share in (0.5, 0.8, 0.95, 1.0):
            least = share * scores.max()
            places = block.candidates(v[i], float(norms[i]), float(least))
            assert set(np.flatnonzero(scores >= least)) <= set(places)
            spared += 500 - len(places)
        assert len(block.candidates(v[i], float(norms[i]), float(norms[i] * norms.max() * 1.01))) == 0
    assert spared > 0.8 * 60 * 4 * 500


def test_query(spark, sf_dir):
    found = queries.op13_length_buckets(spark, sf_dir)
    assert difference(found, connect(sf_dir), SQL["op13_length_buckets"]) is None
    assert found.count() > 0
