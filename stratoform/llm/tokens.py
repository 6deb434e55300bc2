"""Token counts by a linear longest-match automaton.

A word is cut greedily: the longest vocabulary entry that begins it, then the
longest one that begins the rest. Done naively that walks back and forth over
the word. Here the vocabulary is a trie, and each node has a failure link and
the number of pieces that are settled when the link is followed, so a word is
counted in one pass over its bytes and no piece is built.

The vocabulary is a rank file of a byte-level tokenizer (a parameter), whose
entries with a leading blank begin words, as a word is read with one blank
before it. All 256 bytes are entries, so each word can be cut.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and no
tokens. Repeated rows get a row each; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratoform.llm.common import binary, map_batches, record

#: Where the public tokenizers are; a path on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words whose counts a worker keeps; it starts over beyond that.
MEMO_WORDS = 300_000


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The entries of a rank file: base64 and rank, a line each."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """The trie of a vocabulary with failure links and counts of settled pieces.

    ``fail[v]``: the node reached when the string of ``v`` is cut greedily as
    far as it is certain, with the rest still open; ``settled[v]``: how many
    pieces that cut off. An entry cuts itself whole. Any other node takes its
    parent's link and follows links until its own byte can be read.
    """

    def __init__(self, vocabulary: Iterable[bytes]) -> None:
        entries = set(vocabulary)
        if missing := [b for b in range(256) if bytes([b]) not in entries]:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        #: (node << 8 | byte) -> child
        self.step: dict[int, int] = {}
        parents, labels, whole = array("i", [0]), bytearray(1), bytearray(1)
        for entry in sorted(entries, key=lambda e: (len(e), e)):
            at = 0
            for byte in entry:
                key = at << 8 | byte
                after = self.step.get(key)
                if after is None:
                    after = self.step[key] = len(parents)
                    parents.append(at)
                    labels.append(byte)
                    whole.append(0)
                at = after
            whole[at] = 1
        depth = np.zeros(len(parents), np.int32)
        for node in range(1, len(parents)):
            depth[node] = depth[parents[node]] + 1
        self.fail, self.settled = array("i", bytes(4 * len(parents))), array("i", bytes(4 * len(parents)))
        step, fail, settled = self.step, self.fail, self.settled
        for node in np.argsort(depth, kind="stable")[1:].tolist():
            if whole[node]:
                settled[node] = 1
                continue
            # Not an entry: cut what the parent cuts, until the byte goes on from there.
            byte = labels[node]
            at, cut = fail[parents[node]], settled[parents[node]]
            while (after := step.get(at << 8 | byte)) is None:
                cut += settled[at]
                at = fail[at]
            fail[node], settled[node] = after, cut

    def count(self, text: bytes) -> int:
        """The pieces of ``text``, cut greedily from its start."""
        step, fail, settled = self.step, self.fail, self.settled
        at = pieces = 0
        for byte in text:
            while (after := step.get(at << 8 | byte)) is None:
                pieces += settled[at]
                at = fail[at]
            at = after
        while at:
            pieces += settled[at]
            at = fail[at]
        return pieces


_AUTOMATA: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def _automaton(path: str) -> tuple[LongestMatch, dict[bytes, int]]:
    """A worker's automaton of a vocabulary, built once, and its memo of words."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = (LongestMatch(read_vocabulary(path)), {})
    return _AUTOMATA[path]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens, max_word_tokens), a row for each row of ``docs``."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton, memo = _automaton(vocabulary)
        words_in: list[int] = []
        totals: list[int] = []
        most: list[int] = []
        for text in binary(batch.column(1)):
            words = text.split()  # of bytes: the six ASCII blanks only
            counts = [memo.get(w) for w in words]
            if None in counts:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for i, count in enumerate(counts):
                    if count is None:
                        counts[i] = memo[words[i]] = automaton.count(b" " + words[i])
            words_in.append(len(words))
            totals.append(sum(counts))
            most.append(max(counts, default=0))
        return record(
            doc_id=batch.column(0),
            n_words=pa.array(words_in, pa.int64()),
            n_tokens=pa.array(totals, pa.int64()),
            max_word_tokens=pa.array(most, pa.int64()),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, of, "doc_id long, n_words long, n_tokens long, max_word_tokens long")
