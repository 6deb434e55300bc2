"""Targets, quotas and shares against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from stratoform.llm import mixing, queries


def highest_quotients(votes, seats, limits):
    got = [0] * len(votes)
    for _ in range(min(seats, sum(limits))):
        i = max((i for i in range(len(votes)) if got[i] < limits[i] and votes[i]), key=lambda i: (votes[i] / (2 * got[i] + 1), -i), default=None)
        if i is None:
            break
        got[i] += 1
    return got


def test_apportionment_is_by_highest_quotients():
    rng = random.Random(1)
    for _ in range(300):
        votes = [rng.choice([0, 1, 5, 5, 40, 333.3]) * rng.random() for _ in range(rng.randint(1, 8))]
        limits = [rng.choice([0, 1, 3, 30, 300]) for _ in votes]
        seats = rng.randint(0, 120)
        assert mixing.sainte_lague(votes, seats, limits) == highest_quotients(votes, seats, limits)


def test_targets_stop_at_three_times_the_size():
    found = mixing.targets([10, 1000, 1], [1, 2, 3])
    assert found[0] == 30 and found[2] == 3 and sum(found) == pytest.approx(1011)
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


def check(rows, docs):
    """rows: of the query; docs: (doc_id, text, source)."""
    words = defaultdict(int)
    for _, text, source in docs:
        words[source] += len((text or "").split())
    names = sorted(words, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mixing.targets([words[s] for s in names], [1 + i % 3 for i in range(len(names))]), strict=True))
    taken = defaultdict(int)
    by_id = {d: (s, len((t or "").split())) for d, t, s in docs}
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _, _ in docs)
    for r in rows:
        source, size = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size, words[source])
        assert r.target == pytest.approx(target[source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 2 * mixing.BLOCK_WORDS)


def documents(rng, n=300):
    docs = []
    for i in range(n):
        source = rng.choice(["a"] * 5 + ["b", "é", "Z", None, "tiny" if i < 40 else "b"])
        docs.append((i, " ".join(["w"] * rng.choice([0, 1, 7, 60, 500])) if source != "tiny" else "two words", source))
    return [*docs, (1000, None, "a"), (1001, " ", "empty"), (1002, "x " * 5000, "a")]


def test_shares_follow_the_targets(frame, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_ROWS", 20)
    docs = documents(random.Random(2))
    df = frame([(d, t, s) for d, t, s in docs])
    rows = mixing.mixed(df).collect()
    check(rows, docs)
    for r in rows:
        parts = [(p.first, p.n, p.times) for p in r.parts]
        assert sum(n * k for _, n, k in parts) == r.taken
        assert all(0 <= a and a + n <= r.size and 0 < k <= 3 for a, n, k in parts)
        assert all(a + n <= b for (a, n, _), (b, _, _) in zip(parts, parts[1:], strict=False))
    again = mixing.mixed(frame([(d, t, s) for d, t, s in reversed(docs)], 5)).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}


def test_repeated_rows_and_null_ids(frame):
    docs = [(1, "a b c d", "s"), (1, "a b c d", "s"), (None, "e f", None), (None, None, None), (2, "g " * 100, "t")]
    df = frame(docs)
    rows = mixing.mixed(df).collect()
    assert len(rows) == 5 and sum(r.size for r in rows) == 110
    out = mixing.mix(df)
    assert out.columns == [*df.columns, "mix_taken", "mix_parts"]
    assert sum(r.mix_taken for r in out.collect()) == sum(r.taken for r in rows)
    assert out.count() == sum(r.taken > 0 for r in rows)


def test_empty(frame):
    assert mixing.mixed(frame([])).count() == 0
    assert {r.taken for r in mixing.mixed(frame([None, ""])).collect()} == {0}


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(queries.op5_sainte_lague(spark, sf_dir).collect(), docs)
