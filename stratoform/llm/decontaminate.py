"""Benchmark passages in training texts, found in suffix arrays of the training text.

Each block of documents (a shard) becomes one sequence of word numbers and a
suffix array over it, built by prefix doubling in numpy. Every suffix of every
benchmark item is then looked up by binary search, which gives its longest
verbatim match and all places where a whole window of ``WINDOW`` words occurs.

The words are numbered by the items: a word that no item has is a break, which
nothing matches, so suffixes that begin with one need no place in the array.
The items are broadcast in blocks of at most ``BLOCK_WORDS`` words, so what is
shipped is bounded; more items mean more passes over the documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower
case. Null and empty texts have no words and no hits, and items without words
have no windows. An item that is repeated, or has a null id, counts under its
id; null ids are left out of the list of ids but their passages are hit.
Repeated documents get a row each; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratoform.llm.common import alike, binary, map_batches, record

WINDOW = 10
#: Words of benchmark items that are shipped at once (about 60 MB with their table of numbers).
BLOCK_WORDS = 500_000
#: Words in a shard; a document of more is a shard of its own.
SHARD_WORDS = 1_000_000

#: A-Z to a-z; every other ASCII character but 0-9 and a-z to a blank; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of_item(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Items:
    """A block of benchmark items as numbers: word 0 is a break, and items are parted by it."""

    def __init__(self, items: Iterable[tuple[int | None, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        sequence: list[int] = []
        starts, lengths, owners = [], [], []
        for item_id, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of_item(text)]
            if not words:
                continue
            size = min(window, len(words))
            for at in range(len(words) - size + 1):
                starts.append(len(sequence) + at)
                lengths.append(size)
                owners.append(len(self.ids))
            self.ids.append(item_id)
            sequence += [*words, 0]
        self.sequence = np.array([*sequence, *[0] * window], np.int32)
        self.starts = np.array(starts, np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.owners = np.array(owners, np.int64)
        #: The windows to look up, a row each; beyond a short item's end nothing is compared.
        self.windows = self.sequence[self.starts[:, None] + np.arange(window)] if starts else np.zeros((0, window), np.int32)


def suffix_array(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a word of the items, sorted by their first ``depth`` words.

    Prefix doubling: ranks of one word give ranks of two, and so on, until all
    are unique or ``depth`` words are covered. A break ends a suffix.
    """
    at = np.flatnonzero(sequence)
    rank = sequence.astype(np.int64)
    span = 1
    order = np.argsort(rank[at], kind="stable")
    while span < depth and len(at):
        after = np.zeros(len(rank), np.int64)
        after[: len(rank) - span] = rank[span:] if span < len(rank) else 0
        pair = rank[at] * (int(rank.max()) + 1) + after[at]
        order = np.argsort(pair, kind="stable")
        steps = np.empty(len(at), np.int64)
        steps[0] = 1
        steps[1:] = np.diff(pair[order]) != 0
        rank = np.zeros(len(rank), np.int64)
        rank[at[order]] = np.cumsum(steps)
        if steps.all():
            break
        span *= 2
    return at[order]


def _bounds(sequence: np.ndarray, suffixes: np.ndarray, items: Items, upper: bool) -> np.ndarray:
    """For each window the first place in the array whose suffix is not smaller (``upper``: is larger)."""
    low = np.zeros(len(items.starts), np.int64)
    high = np.full(len(items.starts), len(suffixes), np.int64)
    within = np.arange(items.window) < items.lengths[:, None]
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        there = sequence[suffixes[middle][:, None] + np.arange(items.window)]
        differ = (there != items.windows[open_]) & within[open_]
        first = np.argmax(differ, axis=1)
        row = np.arange(len(open_))
        equal = ~differ[row, first]
        smaller = there[row, first] < items.windows[open_, first]
        right = smaller & ~equal | equal if upper else smaller & ~equal
        low[open_] = np.where(right, middle + 1, low[open_])
        high[open_] = np.where(right, high[open_], middle)
    return low


def occurrences(sequence: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(place, window): all places in the sequence where a window of the items occurs."""
    padded = np.concatenate((sequence, np.zeros(items.window, sequence.dtype)))
    suffixes = suffix_array(sequence, items.window)
    low = _bounds(padded, suffixes, items, upper=False)
    high = _bounds(padded, suffixes, items, upper=True)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    first = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) if len(count) else low
    return suffixes[first + np.arange(len(window))], window


def _shards(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    first, shard, size = 0, [], 0
    for i, text in enumerate(texts):
        words = words_of_item(text)
        if shard and size + len(words) > SHARD_WORDS:
            yield first, shard
            first, shard, size = i, [], 0
        shard.append(words)
        size += len(words)
    if shard:
        yield first, shard


def _matches(items: Items, words: list[list[bytes]]) -> dict[int, list[tuple[int, int, int]]]:
    """By document of a shard: (item, first word, words) of the longest verbatim matches of a window or more."""
    get = items.number.get
    bases = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    sequence = np.zeros(bases[-1], np.int32)
    for base, own in zip(bases.tolist(), words, strict=False):
        sequence[base : base + len(own)] = [get(w, 0) for w in own]
    place, window = occurrences(sequence, items)
    # Windows that follow each other in both texts are one match: same item, same shift.
    shift = place - items.starts[window]
    order = np.lexsort((place, shift))
    place, window, shift = place[order], window[order], shift[order]
    owner = items.owners[window]
    end = place + items.lengths[window]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(shift) != 0) | (np.diff(place) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place))[: len(first)] - 1
    doc = np.searchsorted(bases, place[first], "right") - 1
    found: dict[int, list[tuple[int, int, int]]] = {}
    for d, o, a, b in zip(doc.tolist(), owner[first].tolist(), place[first].tolist(), end[last].tolist(), strict=True):
        found.setdefault(d, []).append((o, a - int(bases[d]), b - a))
    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        text = (row[1] or "").encode()
        if block and size + len(text) // 2 > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row[0], text))
        size += len(text) // 2 + 1
    yield block


_MATCH = "array<struct<item_id: long, first: int, n: int>>"


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, matches): the longest verbatim matches of every document.

    ``matches`` holds the item, the first matching word of the document, and
    the number of words. With several blocks of items a document's lists are
    put together by id and text; equal rows of a document keep a row each.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first", pa.int32()), ("n", pa.int32())]))

    def against(block: list[tuple[int | None, bytes]]) -> DataFrame:
        shipped = docs.sparkSession.sparkContext.broadcast(Items(block, window))

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            items = shipped.value
            counts: list[int] = []
            found: list[list[dict]] = []
            for _, words in _shards(binary(batch.column(2))):
                own = _matches(items, words) if items.ids else {}
                counts += map(len, words)
                found += [
                    [{"item_id": items.ids[o], "first": a, "n": n} for o, a, n in sorted(own.get(d, ()))]
                    for d in range(len(words))
                ]
            return record(
                doc_id=batch.column(0),
                text_hash=batch.column(1),
                n_words=pa.array(counts, pa.int64()),
                matches=pa.array(found, kind),
            )

        return map_batches(rows, of, f"doc_id long, text_hash long, n_words long, matches {_MATCH}")

    parts = [against(block) for block in _blocks(benchmark)]
    if len(parts) == 1:
        return parts[0]
    whole = reduce(DataFrame.unionByName, (p.withColumn("block", F.lit(i)) for i, p in enumerate(parts)))
    own = whole.groupBy("doc_id", "text_hash").agg(
        F.first("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set("matches"))).alias("matches"),
        F.count_if(F.col("block") == 0).cast("int").alias("copies"),
    )
    return own.select("doc_id", "text_hash", "n_words", "matches", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``."""
    found = matches(docs, benchmark, window)
    # Union of the matched stretches: sorted by start, each adds what lies beyond the furthest end so far.
    spans = F.sort_array(
        F.transform("matches", lambda m: F.struct(m["first"].alias("a"), (m["first"] + m["n"]).alias("b")))
    )
    hit = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, m: F.struct(
            F.greatest(s["end"], m["b"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(s["end"], m["a"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    ids = F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string")))
    ids = F.sort_array(F.filter(ids, lambda x: x.isNotNull()))
    return found.select(
        "doc_id",
        "text_hash",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of a benchmark item.

    Only ids and hashes of documents that go are moved to meet the texts.
    """
    bad = contamination(docs, benchmark, window).where("contaminated").select("doc_id", "text_hash").distinct()
    return docs.join(bad, alike(docs, bad), "left_anti")


def sha256_of(ids: Iterable[int]) -> str:
    """The digest of a set of item ids, as the query has it."""
    return hashlib.sha256(",".join(sorted({str(i) for i in ids})).encode()).hexdigest()
