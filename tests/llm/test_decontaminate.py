"""Benchmark passages against brute force and SQL."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from compare import connect, difference

from stratoform.llm import decontaminate as dc
from stratoform.llm import queries
from stratoform.llm.sql import SQL


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids, any_item = words(text), set(), set(), False
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for j in range(len(v) - n + 1 if n else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == v[j : j + n]:
                        hit |= set(range(i, i + n))
                        any_item = True
                        if item_id is not None:
                            ids.add(item_id)
        out.append((-1 if doc_id is None else doc_id, len(w), len(hit), len(ids), dc.sha256_of(ids), any_item))
    return sorted(out)


def found(df):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()
    )


@pytest.fixture
def tables(spark, frame):
    rng = random.Random(2)
    vocabulary = ["a", "b", "É", "c3", "the"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([1, 4, 9, 10, 11, 25]))) for i in range(12)]
    items += [(100, None), (101, ""), (102, "..."), (None, some(14)), (3, some(12))]
    docs = []
    for i in range(40):
        parts = [some(rng.randint(0, 15)), rng.choice(items)[1] or "", some(rng.randint(0, 12))]
        docs.append((i, rng.choice([", ", " ", "\n-"]).join(parts).replace("the", "THE!")))
    docs += [(None, items[4][1]), (41, None), (42, ""), (1, docs[1][1]), (1, docs[1][1])]
    return docs, items, frame(docs), spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(tables):
    docs, items, d, b = tables
    assert found(dc.contamination(d, b)) == brute(docs, items)


def test_blocks_of_items_give_the_same(tables, monkeypatch):
    docs, items, d, b = tables
    monkeypatch.setattr(dc, "BLOCK_WORDS", 40)
    assert found(dc.contamination(d, b)) == brute(docs, items)


def test_longest_matches_have_their_places(frame, spark):
    item = " ".join(f"i{k}" for k in range(30))
    doc = f"x y {' '.join(item.split()[3:27])} z"
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    (row,) = dc.matches(frame([doc, "nothing here"]), b).where("size(matches) > 0").collect()
    assert [tuple(m) for m in row.matches] == [(7, 2, 24)]


def test_suffix_array_is_sorted_by_the_first_words():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 4, 300).astype(np.int32)
    got = dc.suffix_array(sequence, 8)

    def key(at):
        tail = sequence[at : at + 8].tolist()
        return tail[: tail.index(0)] if 0 in tail else tail

    keys = [key(at) for at in got]
    assert sorted(got.tolist()) == np.flatnonzero(sequence).tolist()
    assert keys == sorted(keys)


def test_removal_keeps_clean_rows(tables):
    docs, items, d, b = tables
    bad = {(r[0]) for r in brute(docs, items) if r[5]}
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(
        -1 if i is None else i for i, _ in docs if (-1 if i is None else i) not in bad
    )


def test_empty(frame, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not dc.contamination(frame(["some text"]), none).where("contaminated").count()
    assert dc.contamination(frame([]), none).count() == 0


def test_query_matches_sql(spark, sf_dir):
    df = queries.op9_suffix_decontamination(spark, sf_dir)
    assert difference(df, connect(sf_dir), SQL["op9_suffix_decontamination"]) is None
    assert df.where("contaminated").count() > 0
