"""Bloom filter whose state is a table of 64-bit words."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash, hash_pair
from stratoform.session import stage

#: Bits of a block; an item sets bits of one block only.
BLOCK_BITS = 512
_WORDS = BLOCK_BITS // 64


def sizing(expected_items: int, false_positive_rate: float = 0.01) -> tuple[int, int]:
    """Bits, in whole blocks, and hash functions; an empty input is sized as one item."""
    items = max(expected_items, 1)
    bits = int(-(items * math.log(false_positive_rate)) / math.log(2) ** 2)
    return -(-bits // BLOCK_BITS) * BLOCK_BITS, max(int(bits / items * math.log(2)), 1)


@dataclass(frozen=True)
class BloomFilter:
    """Rows ``(word, bits)`` for the words with a bit set, and the parameters.

    The first hash picks an item's block, the second its bits in there, so a
    probe of any number of items is one equi-join by block; Spark ships the
    blocks to all tasks or shuffles both sides, as it does for any join.
    """

    words: DataFrame
    size: int
    hashes: int
    kind: Hash

    @classmethod
    def build(
        cls,
        df: DataFrame,
        column: str,
        expected_items: int = 10_000,
        false_positive_rate: float = 0.01,
        kind: Hash = Hash.FAST,
    ) -> BloomFilter:
        """Filter over the non-null values of ``column``.

        Repeated values set the same bits, so nothing is deduplicated first;
        each task ORs its bits into words and only words are shuffled.
        """
        size, hashes = sizing(expected_items, false_positive_rate)
        hashed = _hashed(df.select(column).where(F.col(column).isNotNull()), column, size, kind)
        at = [F.col("_block") * BLOCK_BITS + bit for bit in _bits(hashes)]
        words = (
            hashed.select(F.explode(F.array(*at)).alias("pos"))
            .groupBy(F.shiftright("pos", 6).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(pos & 63 as int)))").alias("bits"))
        )
        return cls(words, size, hashes, kind)

    @property
    def size_in_bytes(self) -> int:
        return self.size // 8

    def merge(self, other: BloomFilter) -> BloomFilter:
        """Filter of both item sets."""
        if (self.size, self.hashes, self.kind) != (other.size, other.hashes, other.kind):
            raise ValueError("filters differ in size, hash count or hash function")
        words = self.words.unionByName(other.words).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        return replace(self, words=words)

    def stored(self) -> BloomFilter:
        """The same filter with its words written, for use in several queries."""
        return replace(self, words=stage(self.words, "bloom-words"))

    def measured_bytes(self) -> DataFrame:
        """One row ``sketch_bytes``: of the words that are there, as the table holds them."""
        return self.words.agg((F.count(F.lit(1)) * 8).alias("sketch_bytes"))

    def mark(self, df: DataFrame, column: str, output: str = "might_contain") -> DataFrame:
        """``df`` with the answer per row; null values are never contained."""
        own = [F.max(F.when(F.col("word") % _WORDS == i, F.col("bits"))) for i in range(_WORDS)]
        blocks = self.words.groupBy(F.call_function("div", F.col("word"), F.lit(_WORDS)).alias("_at")).agg(
            F.array(*[F.coalesce(w, F.lit(0).cast("bigint")) for w in own]).alias("_words")
        )
        hashed = _hashed(df, column, self.size, self.kind)
        met = hashed.join(blocks, hashed["_block"] == blocks["_at"], "left")
        tests = [F.get("_words", F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _bits(self.hashes)]
        found = F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
        return met.select(*[hashed[c] for c in df.columns], found.alias(output))

    def save(self, path: str) -> None:
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        spark = self.words.sparkSession
        meta = spark.createDataFrame(
            [(self.size, self.hashes, str(self.kind))], "size bigint, hashes int, kind string"
        )
        meta.write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BloomFilter:
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls(spark.read.parquet(f"{path}/words"), meta["size"], meta["hashes"], Hash(meta["kind"]))


def _hashed(df: DataFrame, column: str, size: int, kind: Hash) -> DataFrame:
    """``df`` with an item's block and its second hash, both null for null."""
    h1, h2 = hash_pair(F.col(column), kind)
    return df.withColumns({"_block": F.pmod(h1, F.lit(size // BLOCK_BITS).cast("bigint")), "_h2": h2})


def _bits(hashes: int) -> list[Column]:
    """An item's bits within its block: steps of an odd width, so that they differ."""
    step = F.shiftright("_h2", 9) * 2 + 1
    return [F.pmod(F.col("_h2") + step * i, F.lit(BLOCK_BITS).cast("bigint")) for i in range(hashes)]


def _bit(position: Column) -> Column:
    shift = position.bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
