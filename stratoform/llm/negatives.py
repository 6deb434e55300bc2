"""Hard negatives by inner products, with length buckets and coordinate pruning.

Vectors of whole numbers are searched as in LEMP. They are bucketed by length, a
bucket is dealt into blocks of about ``BLOCK`` vectors, and a block holds, for each
coordinate, its vectors in the order of that coordinate's share of their length. An
anchor ``a`` looks for vectors ``v`` with ``a . v >= t``. With ``s`` the largest length of
the block, only vectors at an angle of at most ``g = arccos(t / (|a| s))`` from
it qualify; if there is none, the block is left out. Else an angle of ``b``
between ``a`` and an axis leaves angles from ``b - g`` to ``b + g`` to the vector, so a
coordinate list is cut to the range of their cosines. The ranges of the
anchor's ``FOCUS`` largest coordinates are intersected, and what is left is
verified by exact inner products.

Positives, the first ``n_positives`` other rows of the anchor's label, have no
threshold at first: each anchor is scored against one block of the longest
vectors of its label, and its last score there prunes all the others.
Negatives have one, since their scores lie between ``low`` and ``high`` hundredths of a
positive's. Anchors meet blocks by number, ``CHUNK`` at a time, and tasks pass
on the first few of each; all rows are searched.

Rows with a null label, a null vector, or a null or non-finite component take no
part, nor do vectors whose length is 2^31 or more, whose products would not
fit 64 bits. A shorter vector counts as zero where it ends. Repeated rows are
rows of their own: a copy of an anchor is one of its other rows. A row with a
null vec_id is no anchor and comes last in a tie. Columns other than the three
named ones are ignored. An empty table gives no rows; there are no texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratoform.llm.common import map_batches, record, ship
from stratoform.session import stage

#: Steps of a component, positives and negatives of each, hundredths of a positive's score.
STEPS, N_POSITIVES, N_NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
BLOCK, CHUNK = 8_192, 2_048
FOCUS = 3
#: Lengths in a bucket differ by this factor at most.
BUCKET_RATIO = 1.1
_LAST = 2**63 - 1
_TOO_LONG = 2.0**62
#: Added to angles and cosines, so that rounding leaves out no vector.
_SLACK = 1e-7

_VECTOR = "row long, vec_id long, label long, norm double, v binary"
_BLOCK = "block long, label long, longest double, rows binary, ids binary, dims int, v binary, order binary"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, norm, v) of the rows that take part; v is of 64-bit whole numbers."""
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    ).where(F.col("label").isNotNull() & F.col("v").isNotNull())

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = batch.column(3)
        kept, norms, out = [], [], []
        for i in range(batch.num_rows):
            x = np.floor(vectors[i].values.to_numpy(zero_copy_only=False).astype(np.float64) * STEPS)  # a null is a NaN
            square = float((x * x).sum())
            if np.isfinite(square) and square < _TOO_LONG:
                kept.append(i)
                norms.append(square**0.5)
                out.append(x.astype(np.int64).tobytes())
        few = batch.take(pa.array(kept, pa.int64()))
        return record(
            row=few.column(0), vec_id=few.column(1), label=few.column(2), norm=pa.array(norms, pa.float64()), v=pa.array(out, pa.binary())
        )

    return map_batches(rows, convert, _VECTOR)


def _matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        own = np.frombuffer(v, np.int64)[:dims]
        out[i, : len(own)] = own
    return out


def _shares(v: np.ndarray) -> np.ndarray:
    """Coordinates of the vectors as shares of their lengths; 0 for a vector of length 0."""
    v = v.astype(np.float64)
    norms = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norms, out=np.zeros_like(v), where=norms > 0)


def blocks(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of one label and one length bucket, numbered from 0, with their sorted coordinate lists."""
    bucketed = vectors.withColumn("bucket", F.floor(F.log(F.greatest("norm", F.lit(1.0))) / float(np.log(BUCKET_RATIO))))
    sizes = bucketed.groupBy("label", "bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    placed = bucketed.join(sizes, ["label", "bucket"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))

    def build(table: pa.Table) -> pa.Table:
        vectors = table.column("v").to_pylist()
        dims = max(len(v) for v in vectors) // 8
        v = _matrix(vectors, dims)
        ids = table.column("vec_id").fill_null(_LAST).to_numpy()
        order = np.argsort(_shares(v), axis=0, kind="stable").T.astype(np.uint32)
        return pa.table(
            {
                "label": table.column("label")[:1],
                "bucket": table.column("bucket")[:1],
                "longest": pa.array([max(table.column("norm").to_pylist())]),
                "rows": pa.array([table.column("row").to_numpy().tobytes()], pa.binary()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "dims": pa.array([dims], pa.int32()),
                "v": pa.array([v.tobytes()], pa.binary()),
                "order": pa.array([order.tobytes()], pa.binary()),
            }
        )

    ship(vectors.sparkSession)
    # One row of each block is numbered; the blocks themselves stay where they are.
    built = stage(
        placed.groupBy("label", "bucket", "part").applyInArrow(
            build, "label long, bucket long, longest double, rows binary, ids binary, dims int, v binary, order binary"
        ).withColumn("place", F.monotonically_increasing_id()),
        "built",
    )
    by_length = Window.orderBy(F.desc("bucket"), "place")
    numbers = built.select("place", "bucket").withColumn("block", F.row_number().over(by_length).cast("long") - 1)
    return stage(built.join(numbers.select("place", "block"), "place").drop("place", "bucket"), "blocks")


class Block:
    """A block's vectors and coordinate lists, decoded as they are needed."""

    def __init__(self, longest: float, rows: bytes, ids: bytes, dims: int, v: bytes, order: bytes) -> None:
        self.rows, self.ids = np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64)
        self.longest, self.dims = longest, dims
        self.v = np.frombuffer(v, np.int64).reshape(len(self.rows), dims)
        self.order = np.frombuffer(order, np.uint32).reshape(dims, len(self.rows))
        self.shares = _shares(self.v)
        self.sorted: dict[int, np.ndarray] = {}

    def _list(self, f: int) -> np.ndarray:
        if f not in self.sorted:
            self.sorted[f] = self.shares[self.order[f], f]
        return self.sorted[f]

    def candidates(self, a: np.ndarray, norm: float, threshold: float, focus: int = FOCUS) -> np.ndarray | None:
        """Places of vectors that may reach the threshold; None if all may."""
        if threshold <= 0 or not len(self.rows):
            return None
        reach = threshold / (norm * self.longest) if norm * self.longest > 0 else 2.0
        if reach > 1 + _SLACK:
            return np.zeros(0, np.int64)
        spread = np.arccos(min(reach - _SLACK, 1.0)) + _SLACK
        # An anchor may have coordinates that no vector here has.
        axes = np.argsort(-np.abs(a[: self.dims]), kind="stable")[:focus]
        hits = np.zeros(len(self.rows), np.uint8)
        for f in axes:
            own = np.arccos(np.clip(a[f] / norm, -1.0, 1.0))
            low, high = np.cos(min(np.pi, own + spread)), np.cos(max(0.0, own - spread))
            values = self._list(int(f))
            start, end = np.searchsorted(values, low - _SLACK), np.searchsorted(values, high + _SLACK, "right")
            hits[self.order[f, start:end]] += 1
        return np.flatnonzero(hits == len(axes))

    def scores(self, a: np.ndarray, places: np.ndarray | None) -> np.ndarray:
        """Exact inner products with the vectors at the places."""
        v = self.v if places is None else self.v[places]
        own = np.zeros(self.dims, np.int64)
        own[: min(self.dims, len(a))] = a[: self.dims]
        return v @ own

    def first(self, scores: np.ndarray, places: np.ndarray | None, n: int) -> np.ndarray:
        """Where in ``scores`` the first n are, by falling score and then rising id."""
        if len(scores) > n:
            least = np.partition(scores, len(scores) - n)[len(scores) - n]
            chosen = np.flatnonzero(scores >= least)
        else:
            chosen = np.arange(len(scores))
        ids = self.ids[chosen if places is None else places[chosen]]
        return chosen[np.lexsort((ids, -scores[chosen]))[:n]]


def _meetings(anchors: DataFrame, found: DataFrame, met: Column) -> tuple[DataFrame, DataFrame]:
    """Anchors with the number of each block they meet, and the blocks once for each chunk of anchors."""
    chunks = anchors.groupBy().agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    n = chunks.first()["chunks"] or 1
    catalogue = found.select(F.col("block"), F.col("label").alias("block_label"), "longest")
    last = found.agg(F.max("block").alias("last")).first()["last"]
    dealt = anchors.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(-1 if last is None else last).cast("long"))))
    dealt = dealt.join(catalogue, "block").where(met).drop("block_label", "longest")
    shown = found.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return dealt, shown


_FOUND = "anchor long, row long, vec_id long, score long"


def _decoded(table: pa.Table) -> Block:
    row = table.slice(0, 1).to_pylist()[0]
    return Block(row["longest"], row["rows"], row["ids"], row["dims"], row["v"], row["order"])


def _best(anchors: DataFrame, found: DataFrame, met: Column, n: int) -> DataFrame:
    """The first ``n`` other rows for each anchor in each block that it meets, from its ``threshold`` on."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            block = _decoded(right)
            for a in left.select(["row", "norm", "v", "threshold"]).to_pylist():
                vector = np.frombuffer(a["v"], np.int64)
                least = -np.inf if a["threshold"] is None else a["threshold"]
                places = block.candidates(vector, a["norm"], least)
                scores = block.scores(vector, places)
                able = np.flatnonzero((scores >= least) & ((block.rows if places is None else block.rows[places]) != a["row"]))
                places = able if places is None else places[able]
                scores = scores[able]
                for i in block.first(scores, places, n):
                    out.append((a["row"], int(block.rows[places[i]]), int(block.ids[places[i]]), int(scores[i])))
        return _table(out, _FOUND)

    dealt, shown = _meetings(anchors, found, met)
    ship(anchors.sparkSession)
    return dealt.groupBy("block", "chunk").cogroup(shown.groupBy("block", "chunk")).applyInArrow(search, _FOUND)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [part.split()[0] for part in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns, strict=True)})


def _ranked(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key by falling score and rising id, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def positives(anchors: DataFrame, found: DataFrame, n: int = N_POSITIVES) -> DataFrame:
    """(anchor, row, vec_id, score, rank): the first ``n`` other rows of each anchor's label."""
    same_label = F.col("label") == F.col("block_label")
    longest = found.groupBy("label").agg(F.min("block").alias("start"))
    start = stage(anchors.join(longest, "label").withColumn("threshold", F.lit(None).cast("double")), "start")
    seeds = stage(_ranked(_best(start, found, same_label & (F.col("block") == F.col("start")), n), ["anchor"], n), "seeds")
    known = seeds.where(F.col("rank") == n).select(F.col("anchor").alias("row"), F.col("score").cast("double").alias("threshold"))
    # Rounding must not lift a threshold above the score it is for.
    pruned = start.drop("threshold").join(known, "row", "left").withColumn("threshold", F.col("threshold") - F.abs("threshold") * 1e-15)
    # The length alone rules most blocks out, before anything moves to them.
    able = F.col("threshold").isNull() | (F.col("threshold") <= F.col("norm") * F.col("longest") * (1 + _SLACK))
    rest = _best(pruned, found, same_label & (F.col("block") != F.col("start")) & able, n)
    return _ranked(seeds.drop("rank").unionByName(rest), ["anchor"], n)


def _negatives(anchors: DataFrame, found: DataFrame, n: int, low: int, high: int) -> DataFrame:
    """(anchor, row, vec_id, score, at): for each anchor and positive, number ``at``, the first of each block."""
    schema = f"{_FOUND}, at long"

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            block = _decoded(right)
            for a in left.select(["row", "norm", "v", "threshold", "scores"]).to_pylist():
                vector = np.frombuffer(a["v"], np.int64)
                places = block.candidates(vector, a["norm"], a["threshold"])
                scores = block.scores(vector, places)
                for at, positive in enumerate(a["scores"], 1):
                    # Bounds in whole numbers, so that no product can overflow.
                    least, most = -(-low * positive // 100), high * positive // 100
                    able = np.flatnonzero((scores >= least) & (scores <= most))
                    there = able if places is None else places[able]
                    for i in block.first(scores[able], there, n):
                        out.append((a["row"], int(block.rows[there[i]]), int(block.ids[there[i]]), int(scores[able[i]]), at))
        return _table(out, schema)

    able = F.col("threshold") <= F.col("norm") * F.col("longest") * (1 + _SLACK)
    dealt, shown = _meetings(anchors, found, (F.col("label") != F.col("block_label")) & able)
    ship(anchors.sparkSession)
    return dealt.groupBy("block", "chunk").cogroup(shown.groupBy("block", "chunk")).applyInArrow(search, schema)


def mine(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    n_positives: int = N_POSITIVES,
    n_negatives: int = N_NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` and ``label`` are expressions of ``vec_id`` and ``label``. For each
    anchor and each of its positives: the first ``n_negatives`` rows of other labels
    that score between ``low`` and ``high`` hundredths of the positive, the best first.
    """
    named = embeddings if label is None else embeddings.select("vec_id", label.alias("label"), "embedding")
    vectors = stage(whole_vectors(named), "vectors")
    found = blocks(vectors, block)
    anchors = stage(vectors.where(is_anchor & F.col("vec_id").isNotNull()), "anchors")
    pairs = stage(positives(anchors, found, n_positives), "positives")
    # No score lies between 80 and 100 hundredths of a negative one.
    usable = pairs.where("score >= 0")
    scores = usable.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
    wanted = anchors.join(scores, anchors["row"] == scores["anchor"]).select(
        "row", "label", "norm", "v", F.col("s.score").alias("scores"), F.col("s.rank").alias("ranks")
    )
    # The lowest positive's bound prunes for all of the anchor's positives.
    wanted = stage(wanted.withColumn("threshold", F.array_min("scores") * (low / 100.0) * (1 - 1e-12)), "wanted")
    ranked = _ranked(_negatives(wanted, found, n_negatives, low, high), ["anchor", "at"], n_negatives)
    of = pairs.select(
        "anchor", F.col("rank").cast("long").alias("at"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score")
    )
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    known = lambda c: F.when(F.col(c) != F.lit(_LAST), F.col(c))
    return (
        ranked.join(of, ["anchor", "at"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            known("positive").alias("positive_id"),
            "rank",
            known("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
