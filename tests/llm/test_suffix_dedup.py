"""Removed bytes against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stratoform.llm import queries, suffix_dedup


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((-1 if doc_id is None else doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def texts(rng, length):
    prose = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passages = [prose(rng.randint(length // 2, 3 * length)) for _ in range(8)] + ["ab" * length, "x" * (2 * length)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(passages)
            cut = rng.randint(0, len(passage) // 2)
            piece = passage[cut : rng.randint(cut, len(passage))]
            if rng.random() < 0.3 and piece:
                at = rng.randrange(len(piece))
                piece = piece[:at] + "#" + piece[at + 1 :]
            parts += [prose(rng.randint(0, 3 * length)), piece]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "ab" * 3 * length), (103, "x" * (length - 1)), (None, rows[3][1])]
    return rows + [rows[5], rows[5], (5, rows[6][1])]


@pytest.mark.parametrize("length", [40, 90])
def test_matches_brute_force(frame, length):
    rows = texts(random.Random(length), length)
    assert found(suffix_dedup.deduplicated(frame(rows), length)) == brute(rows, length)


def test_periodic_texts_need_many_doublings(frame):
    rows = [(1, "x" * 200 + "y" + "x" * 300), (2, "abc" * 120 + "Q" + "abc" * 100), (3, "x" * 90 + "z" + "bca" * 50)]
    assert found(suffix_dedup.deduplicated(frame(rows), 100)) == brute(rows, 100)


def test_anchors_do_not_depend_on_slices(monkeypatch):
    text = bytes(random.Random(3).choices(b"abcd", k=5000))
    shape = suffix_dedup.Shape(100)
    whole = suffix_dedup.anchors(text, shape)
    monkeypatch.setattr(suffix_dedup, "SLICE", 333)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(text, shape), strict=True))


def test_nothing_to_find(frame):
    assert suffix_dedup.deduplicated(frame([])).count() == 0
    rows = [(1, "short"), (2, None)]
    assert found(suffix_dedup.deduplicated(frame(rows))) == brute(rows, 400)


def test_short_strings_are_refused():
    with pytest.raises(ValueError):
        suffix_dedup.Shape(20)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = found(queries.op8_prefix_doubling(spark, sf_dir))
    assert got == brute(rows, 400)
    assert any(r[2] for r in got)


def test_planted_passages_go_if_they_are_long_enough(frame):
    """Passages of 51 to 80 words, each in several documents: those of 400 bytes or more are removed whole, others stay."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in range(51, 81, 2)]
    held = {k: rng.sample(range(300), rng.choice([2, 3, 9])) for k in range(len(passages))}
    rows = []
    for i in range(300):
        own = [p for k, p in enumerate(passages) if i in held[k]]
        rows.append((i, " ".join(x for p in own for x in (prose(rng.randint(20, 90)), p)) + " " + prose(rng.randint(20, 90))))
    got = found(suffix_dedup.deduplicated(frame(rows, 9), 400))
    assert got == brute(rows, 400)
    removed = {r[0]: r[2] for r in got}
    long = {k for k, p in enumerate(passages) if len(p) >= 400}
    assert long and len(long) < len(passages)
    for i, _ in rows:
        least = sum(len(passages[k]) for k in long if i in held[k])
        # Blanks beside a passage are shared too.
        assert least <= removed[i] <= least + 4 * len(passages) * bool(least), i
