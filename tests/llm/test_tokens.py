"""The longest-match automaton against greedy cutting."""

from __future__ import annotations

import random

import pytest

from stratoform.llm import queries, tokens


def greedy(vocabulary, text, longest=None):
    longest = longest or max(map(len, vocabulary))
    at = pieces = 0
    while at < len(text):
        at += next(n for n in range(min(longest, len(text) - at), 0, -1) if text[at : at + n] in vocabulary)
        pieces += 1
    return pieces


def test_automaton_cuts_like_the_greedy_loop():
    rng = random.Random(1)
    singles = {bytes([b]) for b in range(256)}
    for _ in range(30):
        vocabulary = singles | {bytes(rng.choice(b"ab ") for _ in range(rng.randint(2, 7))) for _ in range(25)}
        automaton = tokens.LongestMatch(vocabulary)
        for _ in range(60):
            text = bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 25)))
            assert automaton.count(text) == greedy(vocabulary, text)


def test_a_missing_byte_is_refused():
    with pytest.raises(ValueError):
        tokens.LongestMatch([b"a"])


_LONGEST: dict[int, int] = {}
_PIECES: dict[bytes, int] = {}


def brute(vocabulary, text):
    """By the greedy loop; the vocabulary is the same in all tests, so words are remembered."""
    longest = _LONGEST.setdefault(len(vocabulary), 0) or max(map(len, vocabulary))
    _LONGEST[len(vocabulary)] = longest
    counts = []
    for w in (text or "").encode().split():
        if w not in _PIECES:
            _PIECES[w] = greedy(vocabulary, b" " + w, longest)
        counts.append(_PIECES[w])
    return len(counts), sum(counts), max(counts, default=0)


def test_odd_rows(frame):
    vocabulary = set(tokens.read_vocabulary())
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "Hello wörld 1234"), (4, "x" * 3000), (4, "x" * 3000), (5, "ñ\x0bé" * 50)]
    got = [(r.doc_id, r.n_words, r.n_tokens, r.max_word_tokens) for r in tokens.token_counts(frame(rows)).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(vocabulary, t)) for i, t in rows], key=str)
    assert tokens.token_counts(frame([])).count() == 0


def test_memo_may_start_over(frame, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 2)
    vocabulary = set(tokens.read_vocabulary())
    texts = ["one two three four five", "one two", "five four three"]
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(frame(texts, 1)).collect()}
    assert got == {i: brute(vocabulary, t)[1] for i, t in enumerate(texts)}


def test_query(spark, sf_dir):
    vocabulary = set(tokens.read_vocabulary())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op10_longest_match(spark, sf_dir).collect():
        assert (r.n_words, r.n_tokens, r.max_word_tokens) == brute(vocabulary, docs[r.doc_id])
