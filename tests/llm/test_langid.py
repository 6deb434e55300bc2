"""Kneser-Ney models against a direct formula, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratoform.llm import langid, queries


def normal(text):
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def test_grams_of_texts():
    texts = ["Ab, c", "", "12", "x"]
    grams, place = langid._grams([3, 4, 5, 6], [t.lower() for t in texts])
    shown = ["".join(chr(int(g) >> s & 0xFFFF) for s in (48, 32, 16, 0)) for g in grams]
    assert list(zip(place.tolist(), shown, strict=True)) == [
        (3, "   a"), (3, "  ab"), (3, " ab "), (3, "ab c"), (3, "b c "), (6, "   x"), (6, "  x "),
    ]


def direct(texts):
    """P(c | context) by the textbook recursion."""
    counts = [Counter() for _ in range(5)]
    for t in texts:
        padded = "   " + normal(t) + " "
        counts[4].update(padded[i - 3 : i + 1] for i in range(3, len(padded)))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    totals, kinds, discounts = [None] * 5, [None] * 5, [None] * 5
    for k in range(1, 5):
        totals[k], kinds[k] = defaultdict(int), defaultdict(int)
        for g, n in counts[k].items():
            totals[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1
        one, two = sum(n == 1 for n in counts[k].values()), sum(n == 2 for n in counts[k].values())
        discounts[k] = min(0.95, max(0.1, one / max(1, one + 2 * two)))

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(counts[1]) + 1)
        context = g[:-1]
        if not totals[k][context]:
            return p(g[1:])
        return (max(counts[k][g] - discounts[k], 0) + discounts[k] * kinds[k][context] * p(g[1:])) / totals[k][context]

    return p


def packed(g):
    return np.uint64(sum(ord(c) << 16 * i for i, c in enumerate(reversed(g))))


def test_probabilities_follow_the_formula():
    texts = ["the thin thing then", "a net of tin", "nothing in the tent"]
    grams = np.sort(langid._grams([0, 1, 2], texts)[0])
    model = langid.estimate({"en": np.unique(grams, return_counts=True)})
    p = direct(texts)
    for g in ("  th", "thin", "hint", "xyzq", "zthe", " a n", "tenq"):
        assert model.score(np.array([packed(g)]))[0, 0] == pytest.approx(math.log(p(g)), abs=1e-5)


def test_held_out_accuracy_and_unknown_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.op6_kneser_ney(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count("*")).first()
    assert total > 40 and right / total > 0.95


def test_odd_rows(frame):
    rows = [(i, "the cat sat on the mat and then the dog", None, "en") for i in range(6)]
    rows += [(i, "der Hund und die Katze saßen auf der Matte", None, "de") for i in range(6, 12)]
    rows += [(20, None, None, "en"), (21, "", None, "de"), (22, "123 !", None, "en"), (23, "no language here"), (None, "the mat")]
    docs = frame(rows)
    found = {r.doc_id: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert all(found[i].lang_pred == "en" for i in range(6)) and all(found[i].lang_pred == "de" for i in range(6, 12))
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (20, 21, 22))
    assert found[23].lang_pred in ("en", "de") and found[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_no_training_text(frame):
    docs = frame(["some text", None])
    assert langid.train(docs) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.train(frame([])) is None


def test_long_texts_are_read_in_slices(frame, monkeypatch):
    monkeypatch.setattr(langid, "SLICE", 50)
    rows = [(1, "the thin thing " * 40, None, "en"), (2, "das ist ein Haus " * 40, None, "de")]
    docs = frame(rows)
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.train(docs)).collect()} == {1: "en", 2: "de"}


def test_all_training_texts_calibrate(frame, monkeypatch):
    """Also when there was a bound on their number; equal rows count once."""
    monkeypatch.setattr(langid, "CALIBRATION_TEXTS", 5, raising=False)
    rng = random.Random(2)
    words = {"en": "the thin thing then nothing in a tent".split(), "de": "das ist ein Haus und der Hund dort".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 30))), None, lang) for i, lang in enumerate(("en", "de") * 20)]
    rows += [(50, "123", None, "de"), (None, "zzz the", None, "en"), (None, "zzz the", None, "de")]
    model = langid.train(frame(rows + 3 * rows[:3]))
    measured = [r for r in rows if r[1] != "123"]
    entropies, _ = model.cross_entropies([r[1] for r in measured])
    truth = np.array([model.languages.index(r[3]) for r in measured])
    for k in range(len(model.languages)):
        own = entropies[truth == k, k]
        assert model.limits[k] == pytest.approx(own.mean() + langid.REJECT_DEVIATIONS * own.std(), abs=1e-4)
    right = np.arange(len(truth)), truth
    losses = {s: -np.log(np.maximum(langid._posteriors(entropies, s)[right], 1e-9)).mean() for s in (1, 2, 4, 8, 16, 32, 64)}
    assert model.sharpness == min(losses, key=losses.get)
