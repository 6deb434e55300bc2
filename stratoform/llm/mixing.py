"""Mixing sources to target weights by Sainte-Laguë apportionment of blocks.

A source's documents are dealt into shards by hash and put in a seeded order;
the words of a shard are cut into blocks of equally many words. Blocks are the
seats: sources get them by the highest quotients of their targets, and the
shards of a source by the highest quotients of their words. A shard with quota
q and n blocks takes every block q // n times and q % n seeded ones once more,
so a document's share follows from its place alone.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share
all words; a target stops at ``MOST`` times its source's words, and the rest is
shared again. No block, and so no document, is taken more than ``MOST`` times.

The driver holds one row per shard. A shard has at least ``SHARD_ROWS`` rows on
average, and there are at most about ``MAX_SHARDS`` shards beside one for each
source, so its size is bounded. The number of sources is checked.

Null text has no words. Repeated rows are mixed row by row; a null ``doc_id``
stays null. Without any words all targets are 0.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratoform.llm.common import alike, same, unused, words_of
from stratoform.session import stage

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 16
SHARD_ROWS = 2_000
MAX_SHARDS = 50_000
MAX_SOURCES = 200_000
SEED = 20
#: A prime beyond the blocks of any shard: multiplying by it permutes them.
_STRIDE = 2_147_483_647


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size."""
    out, total = [0.0] * len(sizes), float(sum(sizes))
    open_ = [i for i, size in enumerate(sizes) if size]
    rest = total
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(most * sizes[i])
            rest -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(votes: Sequence[float], seats: int, limits: Sequence[int]) -> list[int]:
    """Seats by the highest quotients votes / (2k + 1), at most ``limits`` each; ties go to the first.

    Rounding the proportional shares is already right for all but about one
    seat of each party, so only those are dealt one by one.
    """
    total = sum(votes)
    if not total:
        return [0] * len(votes)
    seats = min(seats, sum(limits))
    got = [min(m, max(0, int(v * seats / total - 1))) for v, m in zip(votes, limits, strict=True)]
    heap = [(-v / (2 * k + 1), i) for i, (v, k, m) in enumerate(zip(votes, got, limits, strict=True)) if k < m and v]
    heapq.heapify(heap)
    left = seats - sum(got)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < limits[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_hash"),
        F.col("source").cast("string"),
        F.size(words_of(F.col("text").cast("string"))).cast("long").alias("size"),
    )


_PLAN = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("shards", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("words", T.LongType()),
        T.StructField("blocks", T.LongType()),
        T.StructField("quota", T.LongType()),
    ]
)


def _plan(sized: DataFrame, block_words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their shard, a row for each shard with its quota)."""
    spark = sized.sparkSession
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    sources = sources.limit(MAX_SOURCES + 1).collect()
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources.sort(key=lambda r: (r.source is None, r.source or ""))
    rows_per_shard = max(SHARD_ROWS, sum(r.n for r in sources) // MAX_SHARDS)
    counts = [-(-r.n // rows_per_shard) for r in sources]
    # Bounded like the plan, a row per source.
    dealt = spark.createDataFrame(
        [(r.source, n) for r, n in zip(sources, counts, strict=True)], T.StructType(_PLAN.fields[:2])
    )
    placed = sized.join(F.broadcast(dealt), same(sized, dealt, "source")).drop(dealt["source"])
    order = F.xxhash64("doc_id", "text_hash", F.lit(seed))
    placed = placed.withColumn("place", order).withColumn(
        "shard", F.pmod(F.xxhash64("place"), F.col("shards").cast("long")).cast("int")
    )
    shards: dict[str | None, list] = {}
    for r in placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect():
        shards.setdefault(r.source, []).append((r.shard, r.words))
    target = targets([r.words for r in sources], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sources))])
    blocks = {s: [(k, w, max(1, round(w / block_words)) if w else 0) for k, w in sorted(own)] for s, own in shards.items()}
    own_blocks = [sum(n for _, _, n in blocks[r.source]) for r in sources]
    votes = [t * n / r.words if r.words else 0.0 for t, n, r in zip(target, own_blocks, sources, strict=True)]
    seats = sainte_lague(votes, round(sum(votes)), [MOST * n for n in own_blocks])
    plan = []
    for r, n, t, own_seats in zip(sources, counts, target, seats, strict=True):
        own = blocks[r.source]
        quotas = sainte_lague([float(n) for _, _, n in own], own_seats, [MOST * n for _, _, n in own])
        plan += [(r.source, n, k, r.words, t, w, m, q) for (k, w, m), q in zip(own, quotas, strict=True)]
    return placed, spark.createDataFrame(plan, _PLAN)


def _in_blocks(seed: int, body) -> Column:
    """``body(block, words of the row in it, first word, times)`` for each block that a row reaches into."""
    n, w, c = F.col("blocks"), F.col("words"), F.col("before")
    integral = lambda a, b: F.call_function("div", a, b)
    first, last = integral(c * n, w), integral((c + F.col("size") - 1) * n, w)
    begins = lambda k: integral(k * w + n - 1, n)
    shift = F.pmod(F.xxhash64("source", "shard", F.lit(seed)), n)

    def one(k: Column) -> Column:
        start = F.greatest(begins(k), c)
        stop = F.least(begins(k + 1), c + F.col("size"))
        extra = F.pmod(k * _STRIDE + shift, n) < F.pmod(F.col("quota"), n)
        return body(k, stop - start, start - c, integral(F.col("quota"), n) + F.when(extra, 1).otherwise(0))

    return F.transform(F.sequence(first, last), one)


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, size, source_size, target, taken, parts), a row for each row of ``docs``.

    ``parts`` are the word ranges that the mix takes and how often; ``taken``
    is the number of their words, repeats counted.
    """
    placed, plan = _plan(stage(_sized(docs), "sizes"), block_words, seed)
    plan = plan.drop("shards")
    # Ties in this order are equal rows; shards bound the window.
    before = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "text_hash")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = rows.join(F.broadcast(plan), same(rows, plan, "source", "shard")).drop(plan["source"]).drop(plan["shard"])
    parts = _in_blocks(
        seed, lambda k, n, first, times: F.struct(first.alias("first"), n.alias("n"), times.cast("int").alias("times"))
    )
    parts = F.filter(parts, lambda p: (p["times"] > 0) & (p["n"] > 0))
    empty = F.expr("cast(array() as array<struct<first: bigint, n: bigint, times: int>>)")
    rows = rows.withColumn("parts", F.when(F.col("size") > 0, parts).otherwise(empty))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["n"] * p["times"])
    return rows.select("doc_id", "text_hash", "size", "source_size", "target", taken.alias("taken"), "parts")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``mix_taken`` and ``mix_parts`` beside their columns.

    Columns of these two names in ``docs`` are from an earlier mix and are replaced.
    """
    chosen = mixed(docs, block_words, seed).where("taken > 0")
    # Equal rows may be taken in different parts, so they are told apart by number.
    number = Window.partitionBy("doc_id", F.xxhash64("text"))
    chosen = chosen.select(
        "doc_id", "text_hash", F.col("taken").alias("mix_taken"), F.col("parts").alias("mix_parts")
    ).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("mix_taken", "mix_parts")), asc=False).alias("mix"))
    row, taken = unused(docs, "_row"), unused(docs, "_mix")
    numbered = docs.withColumn(row, F.row_number().over(number.orderBy("text")))
    joined = numbered.join(chosen, alike(numbered, chosen)).select(
        *[numbered[c] for c in docs.columns], F.get(chosen["mix"], numbered[row] - 1).alias(taken)
    )
    mixed_in = [F.col(taken)[c].alias(c) for c in ("mix_taken", "mix_parts")]
    own = [F.col(c) for c in docs.columns if c not in ("mix_taken", "mix_parts")]
    return joined.where(F.col(taken).isNotNull()).select(*own, *mixed_in)
