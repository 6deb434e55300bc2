"""The divergence audit against brute force and SQL, its runs, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference

from stratoform.llm import divergence, queries
from stratoform.llm.sql import SQL


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute(rows, min_docs, top=50):
    """From (text, lang, source) triples."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    found = [(a, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for t, a, s in rows]
    out = set()
    for lang in {a for a, _, _ in found}:
        docs = Counter(w for a, _, ws in found if a == lang for w in set(ws))
        kept = sorted(w for w, n in docs.items() if n >= min_docs)
        of = {}
        for a, s, ws in found:
            if a == lang:
                of.setdefault(s, Counter()).update(w for w in ws if w in set(kept))
        every = sum(of.values(), Counter())

        def p(counts, w):
            return 1 + 10**9 * (counts[w] + 5) // (sum(counts[x] for x in kept) + 5 * len(kept))

        for s, own in of.items():
            pairs = [(o, sum(abs(p(own, w) - p(other, w)) for w in kept)) for o, other in of.items() if o != s]
            more = [(w, p(own, w) - p(every, w)) for w in kept if own[w] > 0 and p(own, w) > p(every, w)]
            for part, items in (("pair", pairs), ("term", more)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top}
    return out


def collected(df):
    rows = df.select("lang", "source", "part", "item", "value", "rank").collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def corpus(rng):
    words = ["Apple", "pear", "é", "ÉA", "straße", "日本", "b1c", "x-y", "it's", "zoo"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words[: rng.randint(1, 10)]) for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "B", "é", "c", None, "src"])))
    rows += [(None, "fr", "only"), ("", "fr", "empty"), ("some", "fr", None), (None, None, "silent"), ("12 34", "xx", "digits")]
    rows += [("long " * 30_000, "en", "long")]
    return rows


def table(frame, rows, partitions=5):
    return frame([(i if i % 7 else None, t, s, a) for i, (t, a, s) in enumerate(rows)], partitions)


@pytest.mark.parametrize("block, tile", [(divergence.BLOCK, divergence.TILE), (3, 2)])
def test_matches_brute_force(frame, block, tile):
    rows = corpus(random.Random(1))
    for min_docs in (1, 30):
        got = collected(divergence.audit(table(frame, rows), min_docs, block=block, tile=tile))
        assert got == brute(rows, min_docs)


def test_terms_stop_at_the_top_and_ties_follow_the_items(frame):
    rows = [(" ".join(f"{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"), "en", "many"), ("other", "en", "few")]
    got = collected(divergence.audit(table(frame, rows), 1))
    assert got == brute(rows, 1)
    assert len([r for r in got if r[1] == "many" and r[2] == "term"]) == 50


def test_clashing_columns_and_no_rows(frame):
    rows = corpus(random.Random(2))
    docs = table(frame, rows)
    for name in ("term", "n", "docs", "pos", "size", "tile", "value", "rank", "part", "item", "block"):
        docs = docs.withColumn(name, docs["source"])
    assert collected(divergence.audit(docs, 20)) == brute(rows, 20)
    assert divergence.audit(frame([])).count() == 0


def test_runs_multiply_instead_of_listing_terms():
    rng = np.random.default_rng(3)
    a, b = np.sort(rng.integers(0, 4, 1000)), rng.integers(0, 2, 1000)
    columns = []
    for counts in (a, b):
        at = np.flatnonzero(counts)
        ends, p = divergence.runs(at, counts[at], 1000, int(counts.sum()), 1000)
        dense = np.array([1 + 10**9 * (int(c) + 5) // (int(counts.sum()) + 5000) for c in counts])
        assert np.array_equal(np.repeat(p, np.diff(ends, prepend=0)), dense)
        columns.append((ends, p, dense))
    assert len(columns[0][0]) == 4
    assert divergence.difference(columns[0][:2], columns[1][:2]) == int(np.abs(columns[0][2] - columns[1][2]).sum())


def test_large_counts_stay_exact():
    n, total, size = 10**13, 3 * 10**13, 10**6
    _, p = divergence.runs(np.array([0]), np.array([n]), 1, total, size)
    assert p[0] == 1 + 10**9 * (n + 5) // (total + 5 * size)


def test_probability_is_exact(spark):
    rows = [(10**13, 3 * 10**13, 10**6), (0, 0, 1), (7, 9, 3)]
    df = spark.createDataFrame(rows, "n long, total long, size long")
    got = [r.p for r in df.select(divergence.probability(df.n, df.total, df["size"]).alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in rows]


def test_query(spark, sf_dir):
    assert difference(queries.op11_run_length_audit(spark, sf_dir), connect(sf_dir), SQL["op11_run_length_audit"]) is None
