"""Near copies by SimHash, linked through BK-trees.

A fingerprint has 64 bits; two texts are linked when at most ``RADIUS`` bits
differ. Copies share a fingerprint, so only distinct fingerprints are searched.

Two fingerprints within two bits agree on at least one of three bit bands, so
each band value is a shard, and only fingerprints of one shard are compared.
A shard becomes one or more BK-trees of at most ``TREE_SIZE`` nodes: the child
of a node is keyed by its Hamming distance to it, and a search follows only
edges within the radius of the distance to the query. A shard of more than one
tree is searched by broadcasting each of its trees to all blocks of its
fingerprints: trees and blocks are rows that meet by (shard, tree, block), so
nothing passes through the driver and a task holds one tree and one block.

Null and word-free texts have fingerprint zero and are linked like any other.
``component_id`` is the smallest ``doc_id`` that is reachable; it is null only
if no document of the component has an id. Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratoform.llm.common import alike, binary, components, map_batches, record, unused
from stratoform.session import stage

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Bit offset and width of the bands; one more than the radius.
BANDS = ((0, 21), (21, 21), (42, 22))
TREE_SIZE = 20_000


def digests(text: bytes, size: int) -> bytes:
    """The hashes of a text's shingles of ``size`` words, one after the other."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not words:
        return b""
    whole = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= size:
        return digest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1))
    return b"".join([digest(whole[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)])


def fingerprint(text: bytes) -> int:
    """The SimHash of a text's word shingles, as an unsigned number."""
    rows = np.frombuffer(digests(text, SHINGLE), np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 16):
        total += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.fromiter(map(fingerprint, binary(batch.column(2))), np.uint64, batch.num_rows)
        return record(doc_id=batch.column(0), text_hash=batch.column(1), fp=pa.array(found.view(np.int64)))

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return map_batches(rows, of, "doc_id long, text_hash long, fp long")


class BkTree:
    """Distinct 64-bit numbers; children are keyed by their distance to the parent."""

    def __init__(self, values: list[int]) -> None:
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for node in range(1, len(values)):
            value, at = values[node], 0
            while True:
                distance = (value ^ values[at]).bit_count()
                after = self.children[at].setdefault(distance, node)
                if after == node:
                    break
                at = after

    def within(self, value: int, radius: int) -> Iterator[int]:
        """The tree's values at most ``radius`` bits from ``value``."""
        pending = [0] if self.values else []
        while pending:
            at = pending.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                yield self.values[at]
            children = self.children[at]
            if children:
                for edge in range(max(1, distance - radius), distance + radius + 1):
                    if edge in children:
                        pending.append(children[edge])


def _band(fp: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1))


def links(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): edges that connect the distinct ``fp`` values as all links within ``radius`` do.

    Of the links that a tree and a block find, a spanning forest is returned:
    as many rows as fingerprints at most.
    """
    if radius >= len(BANDS):
        raise ValueError(f"{len(BANDS)} bands find links up to {len(BANDS) - 1} bits")
    shards = F.array(
        *[F.struct(F.lit(i).alias("band"), _band(F.col("fp"), *b).alias("value")) for i, b in enumerate(BANDS)]
    )
    keyed = fps.select("fp", F.explode(shards).alias("s")).select("fp", "s.band", "s.value")
    sizes = keyed.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = keyed.join(sizes, ["band", "value"]).withColumn("trees", F.ceil(F.col("n") / tree_size).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp", "band"), F.col("trees").cast("long")).cast("int"))
    # A shard of t blocks has t trees; each unordered pair (tree, block) meets once.
    every = F.sequence(F.lit(0), F.col("trees") - 1)
    roles = F.flatten(
        F.transform(
            every,
            lambda k: F.array(
                F.struct(F.least(F.col("own"), k).alias("tree"), F.greatest(F.col("own"), k).alias("block"))
            ),
        )
    )
    met = placed.select("fp", "own", "band", "value", F.explode(roles).alias("m"))
    met = met.select("fp", "band", "value", "m.tree", "m.block", (F.col("own") == F.col("m.tree")).alias("in_tree"))
    key = ["band", "value", "tree", "block"]
    # At most two blocks of tree_size fingerprints meet in one group.
    groups = met.groupBy(*key).agg(
        F.collect_list(F.when(F.col("in_tree"), F.col("fp"))).alias("nodes"),
        F.collect_list(F.when(~F.col("in_tree"), F.col("fp"))).alias("queries"),
    )

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = [], []
        for nodes, queries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tree = BkTree([x & 0xFFFFFFFFFFFFFFFF for x in sorted(nodes)])
            parent: dict[int, int] = {}

            def root(x: int, parent: dict[int, int] = parent) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = parent.get(up, up)
                    x = up
                return x

            for query in [x & 0xFFFFFFFFFFFFFFFF for x in sorted(queries)] or tree.values:
                for found in tree.within(query, radius):
                    if (a := root(query)) != (b := root(found)):
                        parent[max(a, b)] = min(a, b)
                        left.append(query)
                        right.append(found)
        as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return record(a=as_long(left), b=as_long(right))

    return map_batches(groups.select("nodes", "queries"), search, "a long, b long").distinct()


def _classes(docs: DataFrame, radius: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for each row; root is the component's smallest fingerprint."""
    found = stage(fingerprints(docs), "fingerprints")
    # Copies are one fingerprint; their smallest id is formed in the map tasks.
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(distinct.select("fp"), radius))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    linked = linked.select("fp", F.coalesce("root", "fp").alias("root"), "low")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    return found.join(linked.join(lows, "root").select("fp", "root", "component_id"), "fp")


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of ``docs``."""
    return _classes(docs, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component of near copies: the one with the smallest id, then the smallest text hash."""
    return keep_first(docs, _classes(docs, radius))


def keep_first(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The first row of each ``root`` by id and text hash; ``classes`` has (doc_id, text_hash, root) for each row.

    The choice is made on ids and hashes, in the map tasks first; the texts
    move once, to meet it. Of equal rows that are chosen, one stays.
    """
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    chosen = classes.groupBy("root").agg(F.min(order).alias("one")).select("one.doc_id", "one.text_hash")
    kept = docs.join(chosen, alike(docs, chosen), "left_semi")
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    number = unused(docs, "_first")
    return kept.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number)
