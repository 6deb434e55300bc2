"""The rule ledger against brute force, SQL, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

from compare import connect, difference

from stratoform.llm import quality, queries
from stratoform.llm.sql import SQL


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_matches_brute_force(frame):
    rng = random.Random(1)
    texts = ["", None, " \n\t ", "a b c d e", "a b c d e a b c d e", "x y é  ñ", "a\x0bb\x0cc\rd", "w " * 5000]
    for _ in range(150):
        texts.append("".join(rng.choice(["ab ", "c ", "d\n", "é# ", " ", "e|f\t", "G\r"]) for _ in range(rng.randint(0, 80))))
    got = {r.doc_id: tuple(r)[1:6] for r in quality.measure(frame(texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_verdicts_null_ids_and_repeated_rows(frame):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(None, good), (1, good), (1, good), (2, "few words"), (3, "same thing " * 30), (4, "a# b# " + good)]
    kept = sorted((r.doc_id or -1, r.base_failed, r.kept) for r in quality.judge(quality.ledger(frame(rows))).collect())
    assert kept == [(-1, False, True), (1, False, True), (1, False, True), (2, True, False), (3, True, False), (4, False, True)]
    assert quality.judge(quality.ledger(frame([]))).count() == 0
    assert quality.ablations(quality.ledger(frame([]))).count() == 0


def test_ablations_count_what_a_rule_alone_removes(frame):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [good, good + " x" * 5, "few", "#", "same thing " * 30, "ALL " + good.upper()]
    ledger = quality.ledger(frame(rows))
    masks = [r.fail_bits for r in ledger.collect()]
    policy = quality.POLICIES["v2"]
    for r in quality.ablations(ledger).collect():
        bit = 1 << [name for name, _ in quality.RULES].index(r.rule)
        hits = [m & policy.mask for m in masks]
        assert r.n_failed == sum(bool(h & bit) for h in hits)
        assert r.n_sole == sum(h == bit for h in hits)
        assert r.n_kept == sum(h == 0 for h in hits)
        assert r.n_kept_without == sum(h & ~bit == 0 for h in hits)


def test_query_matches_sql(spark, sf_dir):
    assert difference(queries.op4_rule_ledger(spark, sf_dir), connect(sf_dir), SQL["op4_rule_ledger"]) is None
