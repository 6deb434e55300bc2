"""What several operators share: text rules, Arrow batches, intermediate tables, components."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratoform.session import stage

#: The white space that separates words: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"

#: 1 for bytes that do not continue a UTF-8 character.
STARTS = np.array([(b & 0xC0) != 0x80 for b in range(256)], dtype=np.int8)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    one_blank = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), BLANKS[1:], F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(one_blank, " ", -1), "")


def binary(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    wide = column.cast(pa.large_string()).cast(pa.large_binary())
    return [b"" if x is None else x for x in wide.to_pylist()]


_SHIPPED: set[str] = set()
#: Documents in an Arrow batch, unless the session has a number of its own; Spark's default suits short rows.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, as ``--py-files`` would; once for each application."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.TemporaryDirectory()  # executors fetch the file while the application runs
    atexit.register(folder.cleanup)
    name = os.path.join(folder.name, f"{package.name}.zip")
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(name)
    _SHIPPED.add(context.applicationId)


def map_batches(
    df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """One call of ``f`` for each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield out

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def record(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one like it, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def alike(docs: DataFrame, keys: DataFrame) -> Column:
    """Whether a row of ``docs`` has the doc_id and text of one of ``keys`` (doc_id, text_hash).

    No column is added to ``docs``, whose own may have any name.
    """
    return docs["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs["text"]) == keys["text_hash"])


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns, where null equals null."""
    return reduce(Column.__and__, (left[n].eqNullSafe(right[n]) for n in names))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge.

    ``edges`` has long columns ``a`` and ``b``. Each round hooks every node's
    larger neighbours to the smallest one around it (large star), then its
    smaller ones likewise (small star), so the number of rounds follows the
    logarithm of the longest path. A round is written to the shared folder;
    nothing is collected but a checksum, which ends the rounds when it repeats.
    """

    def written(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        # What the sum of hashes leaves open, the count and two more sums decide.
        seen = Observation()
        h = F.xxhash64("a", "b")
        observed = pairs.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
            F.sum(F.shiftrightunsigned(h, 32)).alias("high"),
        )
        return stage(observed, "links"), tuple(sorted(seen.get.items()))

    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = written(pairs)
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs, after = written(small.union(least).distinct())
        if after == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
