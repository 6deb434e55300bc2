"""Verbatim repeats by distributed prefix doubling.

Every byte is removed that a string of ``LENGTH`` bytes covers which also
starts anywhere else, in another document or the same one. Strings do not
cross documents and are judged on the input.

A row per byte and round would be many times the text, so only some positions
are sorted: of every ``W`` consecutive 8-byte grams the one with the smallest
hash, the first of equals, is an anchor. Which one it is depends on those bytes
alone, so equal strings have their anchors at equal places, and each string
belongs to its first anchor. The bytes from an anchor to the next are a phrase;
the phrases of a document are the text whose suffixes are sorted.

Spark ranks the anchors by their phrase, then sorts pairs of ranks at offsets
of 1, 2, 4 ... phrases and ranks again. A unique anchor drops out: no string of
it starts elsewhere. An anchor stops where the next doubling might look past
the end of one of its strings; those that stop with equal ranks may share
strings. Among them, all strings of an anchor at once are compared by hash;
where these differ, blocks of strings; and where these do, string by string.

Null text is empty. Equal rows repeat each other, and each gets a row; a null
``doc_id`` stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratoform.llm.common import binary, map_batches, record, same
from stratoform.operators.numbering import with_row_numbers
from stratoform.session import remove, scratch_path, stage

LENGTH = 400
GRAM = 8
#: Bytes of the next phrase that a phrase's name includes.
OVERLAP = 16
#: Strings that are compared at once before they are compared one by one.
BLOCK = 16
#: Windows that are turned into arrays at once.
SLICE = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)


@dataclass(frozen=True)
class Shape:
    """What follows from the length of the strings."""

    length: int = LENGTH

    @property
    def width(self) -> int:
        """Grams in a window: the largest power of two that leaves room for a phrase and its overlap."""
        return 1 << ((self.length - OVERLAP) // 3).bit_length() - 1

    @property
    def reach(self) -> int:
        """How far behind its anchor the last phrase of a suffix may start to be inside every string of the anchor."""
        return self.length + 1 - 2 * self.width - OVERLAP

    def __post_init__(self) -> None:
        if self.length < 40:
            raise ValueError("strings of less than 40 bytes are not supported")


def anchors(text: bytes, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of the anchors of a text of at least ``shape.length`` bytes."""
    windows = len(text) - shape.width - GRAM + 2
    places, firsts = [], []
    last = -1
    for at in range(0, windows, SLICE):
        stop = min(windows, at + SLICE)
        count = stop - at + shape.width - 1
        grams = np.ndarray((count,), "<u8", text, at, (1,))
        lowest = (grams * _MIX) & _HIGH | np.arange(count, dtype=np.uint64)
        step = 1
        while step < shape.width:
            lowest = np.minimum(lowest[:-step], lowest[step:])
            step *= 2
        place = (lowest & ~_HIGH).astype(np.int64) + at
        new = np.flatnonzero(np.diff(place, prepend=last))
        places.append(place[new])
        firsts.append(new + at)
        last = int(place[-1])
    place, first = np.concatenate(places), np.concatenate(firsts)
    return place, first, np.append(first[1:], windows) - 1


def _positions(numbered: DataFrame, shape: Shape) -> DataFrame:
    """(uid, i, name, level, first, last, lead, strings, doc_id, text_hash): a row for each anchor.

    ``first`` to ``last`` are the starts of its strings (``last`` is less if it
    has none), ``lead`` is the anchor's distance from ``first``, ``strings``
    hashes all of them, ``level`` is the last doubling it may take part in. The
    document is named in the row of its first anchor only.
    """

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(8)]
        owners: list[list] = [[], []]
        digest = xxhash.xxh64_intdigest
        ids = (c.to_pylist() for c in batch.columns[:3])
        for text, uid, *owner in zip(binary(batch.column(3)), *ids, strict=True):
            if len(text) < shape.length:
                continue
            place, first, last = anchors(text, shape)
            last = np.minimum(last, len(text) - shape.length)
            a = place.tolist()
            names = [digest(text[x : y + OVERLAP]) for x, y in zip(a, a[1:], strict=False)]
            names.append(digest(text[a[-1] :], 1))
            strings = [
                digest(text[x : y + shape.length]) if y >= x else 0 for x, y in zip(first.tolist(), last.tolist(), strict=True)
            ]
            behind = np.searchsorted(place, place + shape.reach, "right") - np.arange(len(place))
            rows = (
                np.full(len(place), uid),
                np.arange(len(place)),
                np.array(names, np.uint64).view(np.int64),
                np.log2(behind).astype(np.int8),
                first,
                last,
                place - first,
                np.array(strings, np.uint64).view(np.int64),
            )
            for column, values in zip(columns, rows, strict=True):
                column.append(values)
            for column, value in zip(owners, owner, strict=True):
                column += [value, *[None] * (len(place) - 1)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int8(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        names = ("uid", "i", "name", "level", "first", "last", "lead", "strings")
        return record(
            **{
                name: pa.array(np.concatenate(c) if c else [], kind)
                for name, c, kind in zip(names, columns, kinds, strict=True)
            },
            doc_id=pa.array(owners[0], pa.int64()),
            text_hash=pa.array(owners[1], pa.int64()),
        )

    schema = "uid long, i int, name long, level byte, first int, last int, lead int, strings long"
    return map_batches(numbered, of, f"{schema}, doc_id long, text_hash long")


_CARRIED = ("uid", "i", "level", "first", "last", "lead", "strings")


def _reranked(rows: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``rows`` whose ``keys`` are not unique, with the rank of their keys; written.

    Equal keys are counted before anything is sorted, so a key that a third of
    the rows have is one row of the sort.
    """
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ranks = with_row_numbers(repeated, keys, "rank_after")
    return stage(rows.join(ranks, keys).select(*_CARRIED, F.col("rank_after").alias("rank")), "", path)


def candidates(positions: DataFrame, path: str) -> Iterator[DataFrame]:
    """For each doubling the anchors that stop there: (…, level, rank), with strings of equal rank to compare.

    The ranks of each doubling are written below ``path``.
    """
    active = _reranked(positions, ["name"], f"{path}/0")
    for level in range(32):
        yield active.where((F.col("level") == level) & (F.col("last") >= F.col("first")))
        ahead = Window.partitionBy("uid").orderBy("i").rangeBetween(1 << level, 1 << level)
        pairs = active.withColumn("rank_ahead", F.max("rank").over(ahead))
        pairs = pairs.where((F.col("level") > level) & F.col("rank_ahead").isNotNull())
        active = _reranked(pairs, ["rank", "rank_ahead"], f"{path}/{level + 1}")
        if active.isEmpty():
            return


def _split(stopped: DataFrame) -> DataFrame:
    """Adds ``n``, the anchors with equal strings, and ``kinds``, the different strings of a rank."""
    alike = stopped.groupBy("level", "rank", "strings").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "i")).alias("one"))
    kinds = alike.groupBy("level", "rank").agg(F.count(F.lit(1)).alias("kinds"))
    # Written, so that the join with the strings of many copies can be split over tasks.
    counted = stage(alike.join(kinds, ["level", "rank"]).where("n > 1 or kinds > 1"), "alike")
    return stopped.join(counted, ["level", "rank", "strings"])


def _with_texts(docs: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """(text, own): each document that ``wanted`` names, with the wanted rows as an array."""
    own = wanted.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(*columns)).alias("own"))
    return docs.join(own, same(docs, own, "doc_id", "text_hash")).select(docs["text"], "own")


def _blocks(docs: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """(place, core, hull, uid, first, size, n): a row for each block of strings of the wanted anchors.

    A block has the strings whose distances from the anchor differ in less than
    ``BLOCK``; ``place`` names the anchor's rank and the block. The core is
    inside every string of the block, and the hull holds them all.
    """
    wanted = wanted.withColumn("place", F.xxhash64("level", "rank"))
    joined = _with_texts(docs, wanted, "uid", "first", "last", "lead", "n", "place")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        digest, length = xxhash.xxh64_intdigest, shape.length
        for text, own in zip(binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for x in own:
                anchor, at = x["first"] + x["lead"], x["first"]
                while at <= x["last"]:
                    block = (anchor - at) // BLOCK
                    nearest = anchor - block * BLOCK
                    stop = min(x["last"], nearest)
                    core = digest(text[nearest : nearest - BLOCK + 1 + length])
                    hull = digest(text[at : stop + length])
                    rows.append((x["place"] + block & 0x7FFFFFFFFFFFFFFF, core, hull, x["uid"], at, stop - at + 1, x["n"]))
                    at = stop + 1
        place, core, hull, uid, first, size, n = zip(*rows, strict=True) if rows else [()] * 7
        as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return record(
            place=pa.array(place, pa.int64()),
            core=as_long(core),
            hull=as_long(hull),
            uid=pa.array(uid, pa.int64()),
            first=pa.array(first, pa.int32()),
            size=pa.array(size, pa.int32()),
            n=pa.array(n, pa.int64()),
        )

    found = map_batches(joined, of, "place long, core long, hull long, uid long, first int, size int, n long")
    return found.dropDuplicates(["place", "uid", "first"])  # equal rows of a document


def _strings(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(place, string, uid, first, total): the strings of wanted blocks one by one, by hash."""
    joined = _with_texts(docs, wanted, "uid", "first", "size", "place", "total")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, strings, uids, firsts, totals = [], [], [], [], []
        digest = xxhash.xxh64_intdigest
        for text, own in zip(binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for x in own:
                starts = range(x["first"], x["first"] + x["size"])
                strings += [digest(text[p : p + length]) for p in starts]
                places += [x["place"]] * x["size"]
                uids += [x["uid"]] * x["size"]
                firsts += starts
                totals += [x["total"]] * x["size"]
        return record(
            place=pa.array(places, pa.int64()),
            string=pa.array(np.array(strings, np.uint64).view(np.int64)),
            uid=pa.array(uids, pa.int64()),
            first=pa.array(firsts, pa.int32()),
            total=pa.array(totals, pa.int64()),
        )

    found = map_batches(joined, of, "place long, string long, uid long, first int, total long")
    return found.dropDuplicates(["place", "uid", "first"])  # equal rows of a document


def _block_spans(docs: DataFrame, blocks: DataFrame, owners: DataFrame, length: int) -> DataFrame:
    """(uid, first, stop) of the strings of blocks that are repeated.

    Equal hulls (of as many strings) repeat each other whole. A core that only
    one block has makes all strings of the block unique. What is left, blocks
    with a shared core and different hulls, is compared string by string.
    """
    hulls = blocks.groupBy("place", "core", "hull", "size").agg(
        F.sum("n").alias("total"), F.min(F.struct("uid", "first")).alias("one")
    )
    open_cores = hulls.groupBy("place", "core").agg(F.count(F.lit(1)).alias("hulls")).where("hulls > 1").drop("hulls")
    shared = hulls.where("total > 1").select("place", "core", "hull", "size")
    # Strings of anchors that several documents have are known to be repeated already.
    whole = blocks.where("n = 1").join(shared, ["place", "core", "hull", "size"], "left_semi")
    whole = whole.select("uid", "first", (F.col("first") + F.col("size") - 1 + length).alias("stop"))
    chosen = hulls.join(open_cores, ["place", "core"], "left_semi")
    chosen = chosen.select("one.uid", "one.first", "size", F.xxhash64("place", "core").alias("place"), "total")
    strings = stage(_strings(docs, chosen.join(owners, "uid"), length), "strings")
    twice = strings.groupBy("place", "string").agg(F.sum("total").alias("all")).where("all > 1")
    single = strings.where("total = 1").join(twice, ["place", "string"], "left_semi")
    return whole.union(single.select("uid", "first", (F.col("first") + length).alias("stop")))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, spans): the stretches of repeated strings, sorted; documents without any have no row.

    Intermediate tables go as soon as the next ones are written.
    """
    shape = Shape(length)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    # The number of a row holds for what is written here and is not used beyond it.
    numbered = rows.where(F.octet_length("text") >= length).withColumn("uid", F.monotonically_increasing_id())
    paths = {name: scratch_path(spark, name) for name in ("positions", "ranks", "candidates", "blocks")}
    positions = stage(_positions(numbered.select("uid", "doc_id", "text_hash", "text"), shape), "", paths["positions"])
    owners = stage(positions.where("i = 0").select("uid", "doc_id", "text_hash"), "owners")
    stopped = None
    for part in candidates(positions.drop("doc_id", "text_hash"), paths["ranks"]):
        if stopped is None:
            remove(spark, paths["positions"])
        stopped = part if stopped is None else stopped.unionByName(part)
    counted = stage(_split(stopped), "", paths["candidates"])
    remove(spark, paths["ranks"])
    # Anchors with equal strings are compared once, by the first of them.
    chosen = counted.where("kinds > 1 and uid = one.uid and i = one.i")
    blocks = stage(_blocks(rows, chosen.join(owners, "uid"), shape), "", paths["blocks"])
    whole = counted.where("n > 1").select("uid", "first", (F.col("last") + length).alias("stop"))
    spans = whole.union(_block_spans(rows, blocks, owners, length)).join(owners, "uid").groupBy("doc_id", "text_hash")
    found = stage(spans.agg(F.sort_array(F.collect_set(F.struct("first", "stop"))).alias("spans")), "spans")
    remove(spark, paths["candidates"])
    remove(spark, paths["blocks"])
    return found


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of ``docs``."""
    found = repeats(docs, length)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    joined = rows.join(found, same(rows, found, "doc_id", "text_hash"), "left").select(
        rows["doc_id"], rows["text"], F.col("spans.first").alias("first"), F.col("spans.stop").alias("stop")
    )

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, counts, digests = [], [], [], []
        for text, first, stop in zip(binary(batch.column(1)), *(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
            spans = merged(first or [], stop or [])
            kept = hashlib.sha256()
            at = 0
            for a, b in spans:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(b - a for a, b in spans))
            counts.append(len(spans))
            digests.append(kept.hexdigest())
        return record(
            doc_id=batch.column(0),
            n_bytes=pa.array(sizes, pa.int64()),
            n_removed=pa.array(removed, pa.int64()),
            n_spans=pa.array(counts, pa.int64()),
            kept_sha256=pa.array(digests, pa.string()),
        )

    return map_batches(joined, of, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def merged(first: list[int], stop: list[int]) -> list[tuple[int, int]]:
    """Sorted stretches as maximal runs; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in zip(first, stop, strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
