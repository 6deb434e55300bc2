"""Fingerprints and components against brute force."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from stratoform.llm import queries, simhash


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group}
    return sorted(((d if d is not None else -1), f"{f:016x}", ids[g]) for (d, _), f, g in zip(rows, fps, group))


def collected(df):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.fingerprint, r.component_id) for r in df.collect())


def texts(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 40, 200, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 + 3, " ".join(copy)))
    return rows + [(1, None), (5000, ""), (2, " \n"), (5001, "Ä É A B\x0bc"), (None, rows[0][1]), (9, "solo"), (9, "solo")]


def test_components_match_brute_force(frame):
    rows = texts(random.Random(3))
    assert collected(simhash.near_copies(frame(rows))) == brute(rows)


def test_keep_one_of_each_component(frame):
    rows = texts(random.Random(4)) + [(None, "alone and without an id"), (None, "another one without any id")]
    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    components = {}
    for (d, f, c) in brute(rows):
        components.setdefault((c, f) if c is None else c, set()).add(d)
    kept_rows = kept.select("doc_id").collect()
    assert len(kept_rows) == len(components)
    assert {r[0] for r in kept_rows if r[0] is not None} == {c for c in components if not isinstance(c, tuple)}


def test_empty(frame):
    assert simhash.near_copies(frame([])).count() == 0
    assert simhash.keep_one(frame([])).count() == 0


def test_shards_of_several_trees_find_the_same(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base ^ (1 << rng.randrange(21)) ^ (1 << rng.randrange(21)) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")

    def classes(edges):
        parent = {v: v for v in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[root(a)] = root(b)
        return {frozenset(v for v in signed if root(v) == root(u)) for u in signed}

    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    for size in (10, 1000):
        found = [(r.a, r.b) for r in simhash.links(fps, tree_size=size).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in found)
        assert classes(found) == classes(pairs)


def test_tree_follows_only_edges_within_the_radius():
    rng = random.Random(6)
    values = [rng.getrandbits(64) for _ in range(300)]
    values += [v ^ (1 << rng.randrange(64)) for v in values[:50]]
    tree = simhash.BkTree(values)
    for v in values[:60]:
        assert sorted(tree.within(v, 2)) == sorted(u for u in values if (u ^ v).bit_count() <= 2)


def test_radius_beyond_the_bands_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=3)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert collected(queries.op3_bk_trees(spark, sf_dir)) == brute(rows)
