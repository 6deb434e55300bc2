"""How the sources of a language differ, from run-length encoded columns of term counts.

A term is a run of characters other than ``[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``, with
A-Z in lower case. A language keeps the terms that ``MIN_DOCS`` of its documents
have, V of them. A group is a language and a source; it gives a kept term that
occurs ``count`` times in it ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``,
where N adds up its counts. All numbers are whole, so results are exact.

Two groups of a language differ by the sum of ``|p - q|`` over its kept terms.
The vocabulary is put in an order that brings terms of equal counts together:
by the number of sources that have a term, its total, and a hash of all its
counts. A group is a column over that order, cut into blocks of ``BLOCK`` terms
and run-length encoded in each; a term that the group lacks is part of a run
too. Two columns are compared by the union of their run boundaries, each
stretch adding ``|p - q|`` times its length. Columns meet in tiles of ``TILE``
sources, so a task holds two tiles of one block, whatever the vocabulary.

Null text, language and source are ''. A group without terms has zero counts; a
language that keeps no term has V = 0 and differences of 0. Very long texts are
read whole, repeated rows are documents of their own, ids are not used, and an
empty table gives no rows. Columns other than text, lang and source are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratoform.llm.common import binary, map_batches, record, ship
from stratoform.operators.numbering import with_row_numbers
from stratoform.session import remove, scratch_path, stage

MIN_DOCS = 30
SCALE, SMOOTHING = 1_000_000_000, 5
TOP_TERMS = 50
BLOCK, TILE = 1 << 14, 32
#: (source, term) counts that a task holds before it passes them on.
HELD = 300_000

_LETTERS = bytes(b if b > 0x7F or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_LETTERS).lower().split()


def _group_columns(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group.

    A row with the empty term stands for the group, which may have no other.
    Tasks add up what they read, so a frequent term is one row of each.
    """

    def passed_on(n: dict[tuple, Counter], seen: dict[tuple, Counter]) -> pa.RecordBatch:
        rows = [(*group, term, k, seen[group][term]) for group, counts in n.items() for term, k in counts.items()]
        lang, source, term, k, docs_ = zip(*rows, strict=True)
        return record(
            lang=pa.array(lang, pa.string()),
            source=pa.array(source, pa.string()),
            term=pa.array(term, pa.binary()).cast(pa.string()),
            n=pa.array(k, pa.int64()),
            docs=pa.array(docs_, pa.int64()),
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = defaultdict(Counter)
        seen: dict[tuple, Counter] = defaultdict(Counter)
        held = 0
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group, text in zip(groups, binary(batch.column(2)), strict=True):
                own, all_seen = n[group], seen[group]
                before = len(own)
                found = Counter(terms(text))
                own.update(found)
                own[b""] += 0
                all_seen.update(found.keys())
                held += len(own) - before
                if held >= HELD:
                    yield passed_on(n, seen)
                    n.clear()
                    seen.clear()
                    held = 0
        if n:
            yield passed_on(n, seen)

    ship(docs.sparkSession)
    counted = docs.select(*_group_columns(docs), docs["text"].cast("string").alias("text")).mapInArrow(
        count, "lang string, source string, term string, n long, docs long"
    )
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, size: Column) -> Column:
    """p of a count in a group of ``total`` occurrences and ``size`` kept terms; decimals keep it exact."""
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * whole(count + SMOOTHING, 20)
    return F.lit(1).cast("long") + F.call_function("div", top, whole(total + SMOOTHING * size, 20))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, in_lang, pos): the kept terms, numbered so that a language's are together and equal columns close."""
    of_term = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("in_lang"),
        F.sum("docs").alias("docs"),
        F.count(F.lit(1)).alias("sources"),
        F.bit_xor(F.xxhash64("source", "n")).alias("signature"),
    )
    kept = of_term.where(F.col("docs") >= min_docs)
    order = ["lang", "sources", "in_lang", "signature", "term"]
    return with_row_numbers(kept, order, "pos").select("lang", "term", "in_lang", "pos")


def runs(pos: np.ndarray, counts: np.ndarray, length: int, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends and p of the runs of a column of ``length`` terms, of which those at ``pos`` have counts."""
    column = np.zeros(length, np.int64)
    column[pos] = counts
    ends = np.append(np.flatnonzero(np.diff(column)) + 1, length) if length else np.zeros(0, np.int64)
    values, at = np.unique(column[ends - 1], return_inverse=True)
    # Python's whole numbers: the product may pass 64 bits.
    p = [1 + SCALE * (int(c) + SMOOTHING) // (total + SMOOTHING * size) for c in values]
    return ends.astype(np.int32), np.array(p, np.int64)[at]


def difference(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of ``|p - q|`` over two columns of the same length, run by run."""
    ends = np.union1d(left[0], right[0])
    p = left[1][np.searchsorted(left[0], ends)]
    q = right[1][np.searchsorted(right[0], ends)]
    return int((np.abs(p - q) * np.diff(ends, prepend=0)).sum())


def _columns(cells: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(lang, source, tile, tiles, block, ends, p): each group's runs in each block with terms of its language."""
    last = F.greatest(F.col("first"), F.col("first") + F.col("size") - 1)
    blocks = F.sequence(F.floor(F.col("first") / block), F.floor(last / block))
    marked = groups.select("lang", "source", F.explode(blocks).alias("block"), F.lit(None).cast("struct<pos:bigint,n:bigint>").alias("cell"))
    own = cells.select("lang", "source", F.floor(F.col("pos") / block).alias("block"), F.struct("pos", "n").alias("cell"))
    # One row for each group and block: at most ``block`` cells are gathered.
    gathered = marked.unionByName(own).groupBy("lang", "source", "block").agg(F.collect_list("cell").alias("cells"))
    placed = gathered.join(groups, ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", "block", "total", "size", "first", F.col("cells.pos").alias("pos"), F.col("cells.n").alias("n")
    )

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends, values = [], []
        for b, total, size, first, pos, n in zip(*(batch.column(i).to_pylist() for i in range(4, 10)), strict=True):
            start, stop = max(first, b * block), min(first + size, (b + 1) * block)
            e, p = runs(np.array(pos, np.int64) - start, np.array(n, np.int64), stop - start, total, size)
            ends.append(e.tobytes())
            values.append(p.tobytes())
        kept = {name: batch.column(i) for i, name in enumerate(batch.schema.names[:5])}
        return record(**kept, ends=pa.array(ends, pa.binary()), p=pa.array(values, pa.binary()))

    return map_batches(placed, encode, "lang string, source string, tile int, tiles int, block long, ends binary, p binary")


def pair_differences(columns: DataFrame) -> DataFrame:
    """(lang, a, b, value): the difference of each two sources of a language, once, a before b."""
    dealt = columns.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = dealt.select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "ends", "p"
    )

    def compare(table: pa.Table) -> pa.Table:
        sources, tiles = table.column("source").to_pylist(), table.column("tile").to_pylist()
        decoded = [
            (np.frombuffer(e, np.int32), np.frombuffer(p, np.int64))
            for e, p in zip(table.column("ends").to_pylist(), table.column("p").to_pylist(), strict=True)
        ]
        across = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        order = sorted(range(len(sources)), key=lambda i: sources[i])
        found = [
            (sources[i], sources[j], difference(decoded[i], decoded[j]))
            for k, i in enumerate(order)
            for j in order[k + 1 :]
            if not across or tiles[i] != tiles[j]
        ]
        a, b, value = zip(*found, strict=True) if found else ((), (), ())
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * len(found), pa.string()),
                "a": pa.array(a, pa.string()),
                "b": pa.array(b, pa.string()),
                "value": pa.array(value, pa.int64()),
            }
        )

    ship(columns.sparkSession)
    parts = met.groupBy("lang", "block", "low", "high").applyInArrow(compare, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK, tile: int = TILE
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group.

    Part ``pair`` has every other source of the language, by falling difference;
    part ``term`` the ``top_terms`` terms that the group has and gives more than its
    language does, by how much more. Equal values are in the order of the items.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "terms")
    counts = stage(term_counts(docs), "", path)
    kept = kept_terms(counts, min_docs)
    cells = stage(counts.where("term <> ''").join(kept, ["lang", "term"]).select("lang", "source", "term", "pos", "n", "in_lang"), "cells")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("in_lang").alias("in_all"), F.min("pos").alias("first"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = counts.where("term = ''").groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    zero = F.lit(0).cast("long")
    groups = (
        counts.where("term = ''")
        .select("lang", "source")
        .join(of_lang, "lang")
        .join(sizes, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            "tiles",
            F.pmod(F.hash("source"), F.col("tiles")).alias("tile"),
            *[F.coalesce(c, zero).alias(c) for c in ("total", "size", "in_all", "first")],
        )
    )
    groups = stage(groups, "groups")
    remove(spark, path)

    pairs = pair_differences(_columns(cells, groups, block))
    both = pairs.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))), "value")
    p = probability(F.col("n"), F.col("total"), F.col("size"))
    q = probability(F.col("in_lang"), F.col("in_all"), F.col("size"))
    more = cells.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(both, "pair").select(columns).unionByName(
        ranked(more, "term").where(F.col("rank") <= top_terms).select(columns)
    )
