"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the letters of its training texts: probabilities
of a character after the three before it, interpolated with continuation
counts of shorter contexts and absolute discounts. A text gets the language
under which its length-normalised cross-entropy is lowest.

The counts come from all training texts: each task counts its n-grams, Spark
adds them up, and only the distinct n-grams reach the driver, whose number is
checked. The model is one sorted array of n-gram hashes for each order, with a
row of log-probabilities for all languages; it is broadcast. Scores and
rejection are calibrated on all training texts, of which only sums move.

Texts are lower-cased; runs of anything but letters are one blank. Texts that
are null or have no letter are ``und`` with score 0, and so is everything if
there is no training text. Slices of ``SLICE`` characters of a longer text are
read one by one. A null ``doc_id`` is split like an empty one; repeated rows
get a row each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stratoform.llm.common import map_batches, record, ship
from stratoform.session import stage

ORDER = 4
UNKNOWN = "und"
#: Characters that are turned into arrays at once.
SLICE = 400_000
#: N-grams that a task holds before it hands them on.
HELD_GRAMS = 1_000_000
#: Distinct (language, n-gram) pairs that the driver takes; about 24 bytes each there.
MAX_GRAMS = 8_000_000
#: How sharply scores may follow cross-entropies.
SHARPNESS = (1, 2, 4, 8, 16, 32, 64)
#: Measurements are added up as whole numbers of such parts, so that their order does not matter.
PARTS = 1 << 20
#: A text is rejected beyond so many deviations above its language's usual cross-entropy.
REJECT_DEVIATIONS = 5.0

_BLANK, _EDGE = 32, 1
#: Odd, so that multiplication is one to one on 64 bits.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """By code point: 16 bits that stand for a letter (beyond the first plane folded into it), or a blank."""
    if not _LETTERS:
        table = np.full(0x110000, _BLANK, np.uint16)
        for plane in range(0, 0x110000, 0x1000):
            own = [c for c in range(plane, plane + 0x1000) if chr(c).isalpha()]
            table[own] = [c if c < 0x10000 else 0xE000 + c % 0x1900 for c in own]
        _LETTERS.append(table)
    return _LETTERS[0]


def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-cased texts in groups of about ``SLICE`` characters, with their places in the list."""
    places, group, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text or ""), SLICE):
            part = text[at : at + SLICE].lower()
            places.append(i)
            group.append(part)
            size += len(part)
            if size >= SLICE:
                yield places, group
                places, group, size = [], [], 0
    if group:
        yield places, group


def _grams(places: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as four 16-bit characters, place of the text of each).

    A text starts with three blanks and ends with one; texts without a letter have none.
    """
    whole = np.frombuffer(("\x01" + "\x01".join(texts) + "\x01").encode("utf-32-le", "replace"), np.uint32)
    edges = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    codes = _letters()[whole]
    codes[edges] = _EDGE
    blank = codes == _BLANK
    after_gap = np.empty(len(codes), bool)
    after_gap[0] = True
    after_gap[1:] = blank[:-1] | (codes[:-1] == _EDGE)
    codes = codes[~(blank & after_gap)]
    edge = codes == _EDGE
    # A blank before an edge goes as well: the edge itself is the closing blank.
    codes = codes[~((codes == _BLANK) & np.append(edge[1:], False))]
    edge = codes == _EDGE
    owner = np.cumsum(edge) - 1
    empty = edge & np.append(edge[1:], True)
    repeats = np.where(edge, ORDER - 1, 1)
    spread = np.repeat(np.where(edge, _BLANK, codes).astype(np.uint64), repeats)
    first = np.cumsum(repeats) - repeats  # place of each code, or of an edge's first blank
    wanted = first[1:]
    wide = np.uint64(16)
    grams = np.zeros(len(wanted), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        grams = (grams << wide) | spread[wanted - back]
    # What ends at a code belongs to its text; what ends at an edge to the text before it.
    own = owner[1:] - edge[1:]
    ok = ~(edge[1:] & empty[:-1])
    return grams[ok], np.asarray(places)[own[ok]]


def is_training(doc_id: Column) -> Column:
    return split_of(doc_id) != 1


def split_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, n) of all texts with a language."""

    def counted(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> pa.RecordBatch:
        found = [(lang, *_merged(parts)) for lang, parts in sorted(held.items())]
        return record(
            lang=pa.array([lang for lang, grams, _ in found for _ in range(len(grams))], pa.string()),
            gram=pa.array(np.concatenate([np.zeros(0, np.uint64), *[g for _, g, _ in found]]).view(np.int64)),
            n=pa.array(np.concatenate([np.zeros(0, np.int64), *[n for _, _, n in found]])),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                parts = held.setdefault(lang, [])
                for group in _slices([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    parts.append(np.unique(_grams(*group)[0], return_counts=True))
                    if len(parts) > 8:
                        parts[:] = [_merged(parts)]
            if sum(len(g) for parts in held.values() for g, _ in parts) > HELD_GRAMS:
                yield counted(held)
                held = {}
        yield counted(held)

    rows = training.where("text is not null and lang is not null")
    rows = rows.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    ship(training.sparkSession)
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def collected_counts(training: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and their counts by language, on the driver, after a check of their number."""
    counted = stage(gram_counts(training), "grams")
    if (size := counted.count()) > MAX_GRAMS:
        raise ValueError(f"{size} distinct n-grams; raise MAX_GRAMS of {MAX_GRAMS} if the driver has the memory")
    table = counted.toArrow()
    names = table["lang"].to_numpy()
    grams, n = table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
    counts = {}
    for lang in sorted(set(names)):
        own = names == lang
        order = np.argsort(grams[own])
        counts[lang] = (grams[own][order], n[own][order])
    return counts


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


@dataclass
class Model:
    """Sorted hashes of each order with log-probabilities (a column per language), and context weights."""

    languages: list[str]
    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    context_hashes: list[np.ndarray]
    context_logs: list[np.ndarray]
    floor: np.ndarray
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def score(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last character of each n-gram, by language."""
        if order == 0:
            return np.broadcast_to(self.floor, (len(grams), len(self.languages)))
        place, hit = _find(self.hashes[order - 1], grams)
        out = self.logs[order - 1][place]
        missed = np.flatnonzero(~hit)
        if len(missed):
            own = grams[missed]
            at, known = _find(self.context_hashes[order - 1], own >> np.uint64(16))
            weight = np.where(known[:, None], self.context_logs[order - 1][at], 0)
            out[missed] = weight + self.score(own & _low(order - 1), order - 1)
        return out

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character by text and language, characters by text)."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for places, group in _slices(texts):
            grams, place = _grams(places, group)
            logs = self.score(grams)
            for k in range(len(self.languages)):
                total[:, k] -= np.bincount(place, logs[:, k], len(texts))
            count += np.bincount(place, minlength=len(texts))
        return total / np.maximum(count, 1)[:, None], count


def _low(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


def _find(hashes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wanted = grams * _MIX
    place = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return place, hashes[place] == wanted


def _by_hash(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = keys * _MIX
    order = np.argsort(hashes)
    return hashes[order], np.log(values[order]).astype(np.float32)


def estimate(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of sorted n-grams and their counts by language."""
    languages = sorted(counts)
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for lang in languages:
        own = [counts[lang]]
        for order in range(ORDER - 1, 0, -1):
            # A shorter n-gram counts once for each different character before it.
            own.append(np.unique(own[-1][0] & _low(order), return_counts=True))
        tables.append(own[::-1])
    model = Model(languages, [], [], [], [], np.zeros(0))
    lower: np.ndarray | None = None
    lower_keys = np.zeros(0, np.uint64)
    for order in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([t[order - 1][0] for t in tables]))
        contexts, context_of = np.unique(keys >> np.uint64(16), return_inverse=True)
        probability = np.zeros((len(keys), len(languages)))
        weights = np.ones((len(contexts), len(languages)))
        if lower is None:
            below = np.full((len(keys), len(languages)), 1 / (len(keys) + 1))
        else:
            below = lower[np.searchsorted(lower_keys, keys & _low(order - 1))]
        for k, own in enumerate(tables):
            grams, n = own[order - 1]
            once, twice = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
            discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
            at = np.searchsorted(keys, grams)
            total = np.bincount(context_of[at], n, len(contexts))
            kinds = np.bincount(context_of[at], minlength=len(contexts))
            seen = total > 0
            weights[seen, k] = discount * kinds[seen] / total[seen]
            probability[at, k] = np.maximum(n - discount, 0) / total[context_of[at]]
            probability[:, k] += weights[context_of, k] * below[:, k]
        for hashes, logs, (h, v) in (
            (model.hashes, model.logs, _by_hash(keys, probability)),
            (model.context_hashes, model.context_logs, _by_hash(contexts, weights)),
        ):
            hashes.append(h)
            logs.append(v)
        if lower is None:
            # The context weight of order one is applied on the way down to it.
            model.floor = np.full(len(languages), -np.log(len(keys) + 1))
        lower, lower_keys = probability, keys
    return model


def calibrate(model: Model, sums: list[Row]) -> Model:
    """Sets how sharply scores follow cross-entropies, and each language's limit of acceptance.

    ``sums`` has a row for each language: its number of texts, and sums in parts of ``1 / PARTS``.
    """
    model.limits = np.full(len(model.languages), np.inf)
    if not sums:
        return model
    model.sharpness = float(min((sum(int(r[f"loss_{s}"]) for r in sums), s) for s in SHARPNESS)[1])
    for r in sums:
        n, own, squares = int(r.n), int(r.own), int(r.squares)
        if n > 1:
            deviation = math.sqrt(max(0, n * squares - own * own)) / n
            model.limits[model.languages.index(r.lang)] = (own / n + REJECT_DEVIATIONS * deviation) / PARTS
    return model


def _posteriors(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    scaled = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
    return scaled / scaled.sum(axis=1, keepdims=True)


def train(training: DataFrame) -> Model | None:
    """A model of the rows with text and lang, calibrated on all of them; None if no text has a letter."""
    counts = collected_counts(training)
    if not counts:
        return None
    model = estimate(counts)
    known = training.where(F.col("lang").isin(list(counts)) & F.col("text").isNotNull())
    # Texts are measured where they are; repeated rows count once.
    measured = _measured(known, model).dropDuplicates(["doc_id", "lang", "text_hash"])
    whole = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = measured.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        whole(F.col("own")).alias("own"),
        whole(F.col("own") * F.col("own")).alias("squares"),
        *[whole(F.col(f"loss_{s}")).alias(f"loss_{s}") for s in SHARPNESS],
    )
    return calibrate(model, sums.collect())


def _measured(known: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_hash, lang, own, loss_1 ...) of each row with a letter.

    ``own`` is the cross-entropy under the row's language and ``loss_s`` that of
    the languages' scores at a sharpness, both in parts of ``1 / PARTS``.
    """
    shipped = known.sparkSession.sparkContext.broadcast(model)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shipped.value
        entropies, count = own.cross_entropies(batch.column(3).to_pylist())
        some = np.flatnonzero(count)
        at = {lang: k for k, lang in enumerate(own.languages)}
        truth = np.array([at[x] for x in batch.column(2).to_pylist()], np.int64)[some]
        entropies, row = entropies[some], np.arange(len(some))
        parts = lambda x: pa.array(np.rint(x * PARTS).astype(np.int64))
        loss = lambda s: -np.log(np.maximum(_posteriors(entropies, s)[row, truth], 1e-9))
        return record(
            **{name: batch.column(k).take(pa.array(some)) for k, name in enumerate(("doc_id", "text_hash", "lang"))},
            own=parts(entropies[row, truth]),
            **{f"loss_{s}": parts(loss(s)) for s in SHARPNESS},
        )

    names = [F.col("doc_id").cast("string"), F.xxhash64("text").alias("text_hash"), *[F.col(c).cast("string") for c in ("lang", "text")]]
    longs = ", ".join(f"{c} long" for c in ("own", *(f"loss_{s}" for s in SHARPNESS)))
    return map_batches(known.select(*names), of, f"doc_id string, text_hash long, lang string, {longs}")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, accepted), a row for each row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, size = shipped.value, batch.num_rows
        names, score = np.full(size, UNKNOWN, object), np.zeros(size)
        entropy, accepted = np.zeros(size), np.zeros(size, bool)
        if own is not None:
            entropies, count = own.cross_entropies(batch.column(1).to_pylist())
            best = entropies.argmin(axis=1)
            some = count > 0
            row = np.arange(size)
            names[some] = np.array(own.languages, object)[best[some]]
            score[some] = _posteriors(entropies, own.sharpness)[row, best][some]
            entropy = entropies[row, best]
            accepted = some & (entropy <= own.limits[best])
        return record(
            doc_id=batch.column(0),
            lang_pred=pa.array(names.tolist(), pa.string()),
            score=pa.array(np.clip(score, 0, 1)),
            cross_entropy=pa.array(entropy),
            accepted=pa.array(accepted),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(
        rows, of, "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"
    )
