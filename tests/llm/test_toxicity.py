"""Restored spellings, held-out detection, odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratoform.llm import queries, toxicity


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    # The smallest tables have few toxic texts, so these tests take the next size.
    folder = sf_dir.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), folder


@pytest.fixture(scope="module")
def scorer(tables):
    docs, labels, _ = tables
    return toxicity.train(docs.where(toxicity.is_training(F.col("doc_id"))), labels)


@pytest.mark.parametrize(
    ("written", "meant"),
    [("1d10t", "idiot"), ("stuuupid", "stupid"), ("i.d.i.o.t", "idiot"), ("scum!!", "scum"), ("2186", "2186"), ("the", "the"), ("%%%", "")],
)
def test_restored_tokens(scorer, written, meant):
    assert toxicity.restored_token(written, scorer.characters) == meant


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("iiddiioott", "idiot"),
        ("ssttuuppiidd", "stupid"),
        ("$7up1d", "stupid"),
        ("1d1*t", "idiot"),
        ("1 d 1 0 t", "idiot"),
        ("s t u p 1 d", "stupid"),
        ("$ 7 u p 1 d", "stupid"),
        ("i d ! o t", "idiot"),
        ("1d10t 2186 the", "idiot 2186 the"),
    ],
)
def test_each_way_of_spelling_is_read(scorer, written, meant):
    """Doubled letters, signs, hidden letters, and single letters and signs set apart, alone and mixed."""
    assert toxicity.restore(written, scorer.characters) == meant
    assert set(meant.split()) - {"2186"} <= set(scorer.words(written).strip("<>").split("><"))


def test_tokens_of_signs_are_read_only_if_they_spell_something(scorer):
    assert toxicity.restored_token("1996", scorer.characters) == "1996"
    assert toxicity._of_signs("12", scorer.characters) is None
    assert toxicity._of_signs("4&5", scorer.characters) is None
    words = {t: toxicity._of_signs(t, scorer.characters) for t in ("455", "455455", "99999", "682")}
    assert all(w is None or w.isalpha() for w in words.values())


def test_nothing_is_read_twice_and_plain_words_not_at_all(scorer, monkeypatch):
    """A point after a word is no reason to decode it, and four characters are looked up in the model once."""
    tokens, looked_up = [], []
    read, look_up = toxicity.restored_token, toxicity.CharacterModel._log
    monkeypatch.setattr(toxicity, "restored_token", lambda t, m: tokens.append(t) or read(t, m))
    monkeypatch.setattr(toxicity.CharacterModel, "_log", lambda self, c: looked_up.append(c) or look_up(self, c))
    own = toxicity.Scorer(scorer.characters)
    own.characters._memo.clear()
    assert own.words("Plain, words. 1d10t 1d10t; here.") == "<plain><words><idiot><idiot><here>"
    assert tokens == ["1d10t", "1d10t;"]
    assert len(looked_up) == len(set(looked_up)) > 0


def test_long_tokens_are_decoded_in_pieces(scorer, monkeypatch):
    monkeypatch.setattr(toxicity, "LONGEST", 5)
    assert toxicity.restore("1d10t" * 40, scorer.characters) == "idiot" * 40


def test_letters_set_apart_are_joined(scorer):
    assert toxicity.restore("the s t u p i d ones", scorer.characters) == "the stupid ones"


def test_decoding_takes_the_best_path(scorer):
    """Against all paths of small lattices."""
    from itertools import product

    def value(path):
        context, total = "   ", 0.0
        for string, log in path:
            total += log
            for c in string:
                total += scorer.characters.log(context, c)
                context = context[1:] + c
        return total + scorer.characters.log(context, " ")

    for token in ("h3ll0", "th1ss", "a.b1", "eee!"):
        lattice = toxicity.readings(token)
        best = max(product(*lattice), key=value)
        assert toxicity.decode(lattice, scorer.characters) == "".join(s for s, _ in best)


def test_held_out_rows(spark, tables):
    _, labels, folder = tables
    found = queries.op7_noisy_channel(spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) / len(clean) < 0.1
    toxic = [r.score for r in rows if r.toxic == 1]
    assert sum(toxic) / len(toxic) > 3 * sum(r.score for r in rows if r.toxic == 0) / len(clean)


def test_odd_rows(frame, scorer):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "what an idiot you are"), (4, "1d10t " * 3000), (4, "1d10t " * 3000)]
    found = toxicity.scores(frame(rows), scorer).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    quiet = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(quiet) == 1 and quiet.pop() < 0.3
    assert toxicity.scores(frame([]), scorer).count() == 0
    kept = toxicity.keep_clean(frame(rows), scorer)
    assert kept.columns == frame(rows).columns and {1, 2, 3} <= {r.doc_id for r in kept.collect()}


def test_without_labels_nothing_is_toxic(frame, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(["some text", None])
    trained = toxicity.train(docs, labels)
    assert {(r.score, r.predicted) for r in toxicity.scores(docs, trained).collect()} == {(0.0, 0)}
    assert toxicity.train(frame([None]), labels) is None
    assert toxicity.scores(frame([None]), None).first().predicted == 0
