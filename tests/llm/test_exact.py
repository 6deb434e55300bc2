"""Exact copies against brute force, with one filter and with many, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference

from stratoform.llm import exact, queries
from stratoform.llm.sql import SQL


def brute(rows):
    groups = {}
    for d, text in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), d is None, d))
    out = Counter()
    for plain, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        sha = hashlib.sha256(plain.encode()).hexdigest()
        first = True
        for m in members:
            kept = m == best and first
            first = first and not kept
            out[(m[2], best[2], len(members), kept, sha)] += 1
    return out


def collected(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def texts(rng):
    base = ["".join(rng.choice("abc é\n\t\x0b") for _ in range(rng.randint(0, 6))) for _ in range(60)]
    base += [f"a text of its own {i}" for i in range(200)] + ["x" * 100_000, "x" * 99_999 + " x", "ß ẞ", " ", "\x85a", "a "]
    rows = [(i, rng.choice(base)) for i in range(600)] + [(None, "twice"), (None, "twi ce"), (None, None), (7, None), (8, ""), (8, "")]
    rows += [(1000 + i, "hot copies" + " " * (i % 3)) for i in range(300)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("slice_rows", [exact.SLICE_ROWS, 100])
def test_matches_brute_force(frame, slice_rows):
    rows = texts(random.Random(1))
    assert collected(exact.copies(frame(rows, 7), slice_rows)) == brute(rows)


def test_keep_one_returns_the_rows_that_stay(frame):
    rows = texts(random.Random(2))
    docs = frame(rows, 5)
    for name in ("sha", "n_chars", "kept", "row", "slice", "maybe", "doc", "one_stays", "h"):
        docs = docs.withColumn(name, docs["source"] if name != "n_chars" else docs["n_chars"])
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    expected = Counter()
    for (d, _, _, stays, sha), n in brute(rows).items():
        if stays:
            expected[(d, sha)] += n
    found = Counter((r.doc_id, hashlib.sha256(plain(r.text).encode()).hexdigest()) for r in kept.collect())
    assert found == expected


def test_one_of_many_rows_alike_in_everything_stays(frame):
    docs = frame([(5, "the same")] * 50 + [(6, "the same")] * 50, 4)
    assert [r.doc_id for r in exact.keep_one(docs).collect()] == [5]


def test_empty(frame):
    assert exact.copies(frame([])).count() == 0
    assert exact.keep_one(frame([])).count() == 0


def test_the_filter_misses_no_repeated_hash_and_few_others_pass(spark):
    rng = np.random.default_rng(3)
    once = rng.integers(-(2**62), 2**62, 40_000)
    twice = rng.integers(-(2**62), 2**62, 500)
    values = np.concatenate([once, twice, twice, np.full(2_000, 77)])
    rng.shuffle(values)
    bits = exact.filter_bits(len(values))
    rows = spark.createDataFrame([(int(v),) for v in values], "h long").repartition(6)
    found = exact.repeated_bits(rows, bits)
    hit = lambda v: ((found[(at := exact.places(v.view(np.uint64), bits)) >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
    assert hit(twice).all() and hit(np.array([77])).all()
    assert hit(once).mean() < 0.03


def test_rows_without_a_copy_are_not_shuffled(frame):
    """Only what the filter lets through is exchanged: the plan's other branch is a plain scan."""
    plan = exact.copies(frame([f"text {i}" for i in range(100)]))._jdf.queryExecution().optimizedPlan().toString()
    scan, _, grouped = plan.partition("Join")
    assert "Aggregate" not in scan and "Aggregate" in grouped


def test_query(spark, sf_dir):
    assert difference(queries.op12_two_pass_bloom(spark, sf_dir), connect(sf_dir), SQL["op12_two_pass_bloom"]) is None
