"""Exact copies by two passes over Bloom filters.

Texts are equal when they are after deleting white space (``[\\x20\\x09-\\x0D]``);
a text is known by its SHA-256. The first pass marks every row's bits in a
filter that also notes which bits were marked twice. The second pass reads the
rows again: one with a bit that was not marked twice is alone and passes
straight on. Only the others, which may be repeated, are shuffled, grouped by
SHA-256, and so decided exactly; a false positive costs a shuffle and nothing else.

A filter has ``BITS_PER_ROW`` bits for each row. Rows are dealt by hash into
slices of about ``SLICE_ROWS`` different ones, written without an exchange, and
each slice has a filter of its own. So what is shipped to the tasks is 32 MB at
most, however many rows there are, and every row still is read once in each pass.

Null text is empty, and empty texts are copies of each other. Of equal texts
the row with the most code points stays, then the one with the smallest doc_id;
a null id comes last. Of rows alike in both, one stays. Very long texts
are hashed whole. An empty table gives no rows. Other columns, whatever their
names, play no part and are returned by ``keep_one`` as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratoform.llm.common import BLANKS, map_batches, ship
from stratoform.session import remove, scratch_path, stage

SLICE_ROWS = 1 << 24
BITS_PER_ROW = 16
SEGMENT_BITS = 1 << 15
#: Rows whose bits a task holds before it passes them on.
HELD_ROWS = 1 << 20

_ROW = "doc_id long, n_chars long, sha binary, h long, row long"


def normalised(text: Column) -> Column:
    """The text without white space; empty for null."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), BLANKS, F.coalesce(text.cast("string"), F.lit("")))


def _identity(docs: DataFrame) -> list[Column]:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return [
        docs["doc_id"].cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(normalised(docs["text"]).cast("binary"), 256)).alias("sha"),
    ]


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each hash, of a power of two."""
    h = h.astype(np.uint64)
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask], axis=1).astype(np.int64)


def filter_bits(rows: int) -> int:
    """Size of a filter for so many rows, in bits: a power of two."""
    return max(SEGMENT_BITS, 1 << (max(rows, 1) * BITS_PER_ROW - 1).bit_length())


def _by_segment(marked: np.ndarray) -> dict[int, bytes]:
    """Sorted bit numbers as 16-bit offsets in each segment."""
    if not len(marked):
        return {}
    segments = marked // SEGMENT_BITS
    starts = np.flatnonzero(np.diff(segments, prepend=-1))
    parts = np.split((marked % SEGMENT_BITS).astype(np.uint16), starts[1:])
    return {int(segments[s]): part.tobytes() for s, part in zip(starts, parts, strict=True)}


def _marks(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    values, times = np.unique(np.concatenate(held), return_counts=True)
    at = places(values.view(np.uint64), bits)
    marked, n = np.unique(at, return_counts=True)
    twice = np.unique(np.concatenate([marked[n > 1], at[times > 1].ravel()]))
    seen, again = _by_segment(marked), _by_segment(twice)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(seen), pa.int64()),
            pa.array(list(seen.values()), pa.binary()),
            pa.array([again.get(s, b"") for s in seen], pa.binary()),
        ],
        names=["segment", "seen", "twice"],
    )


def repeated_bits(rows: DataFrame, bits: int) -> np.ndarray:
    """The filter of bits that different rows of column ``h`` share, packed; the first pass.

    Tasks pass on the bits of their rows by segment, each hash once, and a
    segment is put together from all of them. Only whole segments reach the
    driver: ``bits`` / 8 bytes at most.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= HELD_ROWS:
                yield _marks(held, bits)
                held, n = [], 0
        if n:
            yield _marks(held, bits)

    def merge(table: pa.Table) -> pa.Table:
        def offsets(name: str) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint16)

        shared = np.bincount(offsets("seen"), minlength=SEGMENT_BITS) > 1
        shared[offsets("twice")] = True
        packed = np.packbits(shared, bitorder="little").tobytes()
        return pa.table({"segment": table.column("segment")[:1], "shared": pa.array([packed], pa.binary())})

    ship(rows.sparkSession)
    marks = rows.select("h").mapInArrow(mark, "segment long, seen binary, twice binary")
    merged = marks.groupBy("segment").applyInArrow(merge, "segment long, shared binary")
    found = np.zeros(bits // 8, np.uint8)
    size = SEGMENT_BITS // 8
    for row in merged.toLocalIterator():
        found[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.shared, np.uint8)
    return found


def _tested(rows: DataFrame, bits: int) -> DataFrame:
    """The rows with ``maybe``: whether all their bits are shared; the second pass."""
    shipped = rows.sparkSession.sparkContext.broadcast(repeated_bits(rows, bits))

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = places(batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64), bits)
        hit = (shipped.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit.all(axis=1))], names=[*batch.schema.names, "maybe"])

    return map_batches(rows, test, f"{_ROW}, maybe boolean")


def _decided(docs: DataFrame, slice_rows: int) -> DataFrame:
    """(doc_id, n_chars, sha, keep_id, group_size, kept) for each row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    n = docs.count()
    slices = -(-n // slice_rows) or 1
    bits = filter_bits(min(n, slice_rows))
    rows = docs.select(*_identity(docs)).withColumn("h", F.xxhash64("sha")).withColumn("row", F.monotonically_increasing_id())
    # Written once: the number of a row then is fixed, and no text is read again.
    path, tested = scratch_path(spark, "hashes"), scratch_path(spark, "tested")
    dealt = rows.withColumn("slice", F.pmod(F.hash("sha"), F.lit(slices)))
    dealt.write.partitionBy("slice").parquet(path)
    written = spark.read.schema(f"{_ROW}, slice int").parquet(path)
    for k in range(slices):
        own = _tested(written.where(F.col("slice") == k).drop("slice"), bits)
        own.write.partitionBy("maybe").parquet(f"{tested}/slice={k}")
    remove(spark, path)
    read = spark.read.schema(f"{_ROW}, slice int, maybe boolean").parquet(tested)
    alone = read.where(~F.col("maybe")).select(
        "doc_id", "n_chars", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    maybe = read.where("maybe").select("doc_id", "n_chars", "sha", "row")
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    # A hot text is one row of each map task before it is shuffled.
    groups = maybe.groupBy("sha").agg(F.min(order).alias("one"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join is of two plain tables and Spark splits the rows of a hot text over tasks.
    groups = stage(groups, "groups")
    repeated = maybe.join(groups, "sha").select(
        "doc_id", "n_chars", "sha", F.col("one.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("one.row")).alias("kept")
    )
    return alone.unionByName(repeated)


def copies(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of ``docs``."""
    return _decided(docs, slice_rows).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def keep_one(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they came with.

    Rows without a copy are not shuffled: what goes is small and met by key.
    """
    key = ["doc_id", "n_chars", "sha"]
    gone = _decided(docs, slice_rows).groupBy(*key).agg(F.bool_or("kept").alias("one_stays"), F.bool_and("kept").alias("all_stay"))
    gone = gone.where("not all_stay").select(*key, "one_stays")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *_identity(docs))
    met = reduce(Column.__and__, (rows[k].eqNullSafe(gone[k]) for k in key))
    joined = rows.join(gone, met, "left").select("doc", *[rows[k] for k in key], "one_stays")
    first = Window.partitionBy(*key).orderBy(F.xxhash64("doc"))
    alike = joined.where("one_stays").withColumn("_first", F.row_number().over(first)).where("_first = 1")
    return joined.where("one_stays is null").select("doc.*").unionByName(alike.select("doc.*"))
