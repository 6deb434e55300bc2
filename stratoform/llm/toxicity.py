"""Toxicity of texts as they were meant, not as they were spelled.

Obfuscated words are restored through a noisy channel: each observed sign may
stand for itself, for the letters it is used for, or for nothing; a repeated
sign for one or two; letters and signs set apart by blanks or points for one
word. The readings form a lattice of characters, and Viterbi decoding, which
keeps all states, takes the path that a character language model of the corpus
likes best. Words of letters none of which is doubled have a single path and
are left alone; of a word with doubled letters both spellings count. A token of
signs only, a number say, is read as letters if the model likes them better
than letters at random. A token of more than ``LONGEST`` runs of equal
characters is decoded in pieces of that many.

The restored words are scored by the character n-grams that labelled toxic
texts have and others lack; a text's score is a logistic function of its worst
words. The language model counts all texts. The n-gram weights are learned
from at most ``TRAINING_TEXTS`` labelled rows, the first by hash of the id, and
the ``MAX_WEIGHTS`` strongest are kept; the logistic function sees each half of
them with the weights of the other half.

Null and empty texts have no words; their score is that of a text without any
evidence. Without toxic or without other labelled texts all scores are 0. A
null ``doc_id`` has no label and is split like an empty one; repeated rows get
a row each; of several labels of one id the largest counts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.llm import langid
from stratoform.llm.common import alike, map_batches, record

TRAINING_TEXTS = 12_000
THRESHOLD = 0.3
SIZES = (4, 5, 6)
#: An n-gram needs as many toxic texts, and so much evidence (natural log of the odds).
MIN_TEXTS, MIN_WEIGHT = 4, 2.0
#: N-grams kept, the strongest first; a worker holds them in a table.
MAX_WEIGHTS = 200_000
#: Tokens whose words a worker keeps, and four characters whose log-probability it keeps; it starts over beyond that.
MEMO_TOKENS, MEMO_GRAMS = 200_000, 200_000

#: The letters that a sign is used for.
MEANT = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
}
#: Any letter may be behind this one.
HIDDEN = "*"
_LOG = {"meant": math.log(0.5), "dropped": math.log(0.2), "halved": math.log(0.1), "hidden": math.log(0.2), "space": math.log(0.3)}
#: Runs of equal characters that are decoded at once; words have fewer.
LONGEST = 60
#: Log-probability of a letter drawn at random.
_RANDOM = -math.log(26)
_EDGES = ".,;:!?\"'()[]{}<>«»„“”…-_=/\\|#%&"
_DECORATION = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$")
_RUN = re.compile(r"(.)\1*", re.S)
_TWICE = re.compile(r"([^\W\d_])\1")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_SIGN = rf"(?:[^\W\d_]|[{re.escape(''.join(MEANT) + HIDDEN)}])"
_APART = re.compile(rf"(?<!\S){_SIGN}(?: {_SIGN}){{2,}}(?!\S)")
_LETTERS = re.compile(r"[^\W\d_]+")


class CharacterModel:
    """Log-probabilities of a character after up to three others, for single look-ups."""

    def __init__(self, model: langid.Model) -> None:
        self._grams = [dict(zip(h.tolist(), v[:, 0].tolist(), strict=True)) for h, v in zip(model.hashes, model.logs, strict=True)]
        self._weights = [
            dict(zip(h.tolist(), v[:, 0].tolist(), strict=True))
            for h, v in zip(model.context_hashes, model.context_logs, strict=True)
        ]
        self._floor = float(model.floor[0])
        self._mix = int(langid._MIX)
        self._memo: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": {}}  # each worker makes its own

    def log(self, context: str, char: str) -> float:
        """Of ``char`` after the last three characters of ``context``; blanks stand before a text."""
        chars = context[-3:] + char
        found = self._memo.get(chars)
        if found is None:
            if len(self._memo) > MEMO_GRAMS:
                self._memo.clear()
            found = self._memo[chars] = self._log(chars)
        return found

    def _log(self, chars: str) -> float:
        gram = 0
        for c in chars.rjust(4):
            gram = gram << 16 | (ord(c) & 0xFFFF)
        total = 0.0
        for order in range(langid.ORDER, 0, -1):
            gram &= (1 << 16 * order) - 1
            found = self._grams[order - 1].get(gram * self._mix & 0xFFFFFFFFFFFFFFFF)
            if found is not None:
                return total + found
            total += self._weights[order - 1].get((gram >> 16) * self._mix & 0xFFFFFFFFFFFFFFFF, 0.0)
        return total + self._floor


def readings(token: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each run of a sign the strings it may stand for, with log-probabilities."""
    lattice = []
    for run in _RUN.finditer(token):
        sign, size = run.group(1), len(run.group(0))
        if size == 1 and sign.isalpha():
            lattice.append([(sign, 0.0)])
        elif sign.isalpha():
            ways = [(sign * min(size, 2), 0.0), (sign, 0.0 if size > 2 else _LOG["halved"])]
            lattice.append(ways)
        elif sign == " " and apart:
            lattice.append([("", 0.0), (" ", _LOG["space"])])
        else:
            ways = [("", _LOG["dropped"] * (1 if size > 1 else 2 if sign in MEANT else 1))]
            for letter in MEANT.get(sign, ""):
                ways.append((letter, _LOG["meant"]))
                if size > 1:
                    ways.append((letter * 2, _LOG["meant"]))
            if sign == HIDDEN:
                ways += [(c * min(size, 3), _LOG["hidden"]) for c in "abcdefghijklmnopqrstuvwxyz"]
            lattice.append(ways)
    return lattice


def decode(lattice: list[list[tuple[str, float]]], model: CharacterModel) -> str:
    """The most likely reading: Viterbi over all states of three characters, in pieces of ``LONGEST`` steps."""
    if len(lattice) > LONGEST:
        return "".join(decode(lattice[i : i + LONGEST], model) for i in range(0, len(lattice), LONGEST))
    states = {"   ": (0.0, "")}
    for ways in lattice:
        after: dict[str, tuple[float, str]] = {}
        if len(ways) == 1 and len(ways[0][0]) == 1:
            char, log = ways[0]
            for context, (score, text) in states.items():
                own, total = context[1:] + char, score + log + model.log(context, char)
                if own not in after or total > after[own][0]:
                    after[own] = (total, text + char)
            states = after
            continue
        for context, (score, text) in states.items():
            for string, log in ways:
                own, total = context, score + log
                for char in string:
                    total += model.log(own, char)
                    own = own[1:] + char
                if own not in after or total > after[own][0]:
                    after[own] = (total, text + string)
        states = after
    return max((score + model.log(context, " "), text) for context, (score, text) in states.items())[1]


def plain(token: str) -> str:
    """A lower-cased token without decoration and punctuation around it."""
    return _DECORATION.sub("", _DECORATION.sub("", token)).strip(_EDGES)


def restored_token(token: str, model: CharacterModel) -> str:
    core = plain(token)
    if core.isalpha():
        if not _TWICE.search(core):
            return core
    elif not any(c.isalpha() for c in core):
        return _of_signs(_DECORATION.sub("", token).strip(".,;:?\"'"), model) or core
    # Signs at the end may be letters as well, so what was cut off but points and commas comes back.
    core = _DECORATION.sub("", _DECORATION.sub("", token)).strip(".,;:?\"'")
    return decode(readings(core), model)


def _of_signs(token: str, model: CharacterModel) -> str | None:
    """The word that a token of signs spells, each of which must stand for a letter; None if it is none."""
    if len(token) < 3 or not all(c in MEANT for c in token):
        return None
    word = decode([[way for way in ways if way[0]] for ways in readings(token)], model)
    total = sum(model.log(" " + word[:i], c) for i, c in enumerate(word + " "))
    return word if total / (len(word) + 1) > _RANDOM else None


def restore(text: str, model: CharacterModel) -> str:
    """The text in lower case, its tokens restored and parted by single blanks."""
    lowered = text.lower()
    tokens = lowered.split()
    if sum(len(t) == 1 for t in tokens) > 2:
        joined = _APART.sub(lambda m: decode(readings(m.group(0), apart=True), model), " ".join(tokens))
        tokens = joined.split()
    return " ".join(restored_token(t, model) for t in tokens)


def grams_of(word: str) -> list[str]:
    """The character n-grams of a word with its edges, and the whole word."""
    edged = f"<{word}>"
    return [edged] + [edged[i : i + n] for n in SIZES for i in range(len(edged) - n + 1) if len(edged) > n]


def split_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def is_training(doc_id: Column) -> Column:
    return split_of(doc_id) != 2


@dataclass
class Scorer:
    """Restores texts and scores them; ``weights`` are of n-grams, ``line`` of the logistic function."""

    characters: CharacterModel
    weights: dict[str, float] = field(default_factory=dict)
    line: np.ndarray | None = None
    _memo: dict[str, str] = field(default_factory=dict, repr=False)
    _search: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": {}, "_search": None}  # each worker makes its own

    def _edged(self, token: str) -> str:
        """The words of a token that is not plain, with the edges between them; remembered."""
        found = self._memo.get(token)
        if found is None:
            if len(self._memo) > MEMO_TOKENS:
                self._memo.clear()
            words = _LETTERS.findall(restored_token(token, self.characters))
            if token.isalpha() and not _THRICE.search(token) and token not in words:
                words.append(token)
            found = self._memo[token] = "><".join(words)
        return found

    def words(self, text: str | None) -> str:
        """All restored words as ``<one><two>``, those of letters set apart once more at the end."""
        lowered = (text or "").lower()
        tokens = lowered.split()
        # Letters, points and commas after them aside, none of which is doubled, are a word as they are.
        if _TWICE.search(lowered):
            words = [c if (c := t.rstrip(".,")).isalpha() and not _TWICE.search(c) else self._edged(t) for t in tokens]
        else:
            words = [c if (c := t.rstrip(".,")).isalpha() else self._edged(t) for t in tokens]
        if sum(map((1).__eq__, map(len, tokens))) > 2:
            for m in _APART.finditer(" ".join(tokens)):
                words += decode(readings(m.group(0), apart=True), self.characters).split()
        return f"<{'><'.join(words)}>"

    def evidence(self, text: str | None) -> list[float]:
        """The weights of the two worst words, and the numbers of bad words and of words, as logarithms."""
        if self._search is None and self.weights:
            self._search = ahocorasick.Automaton()
            for gram, weight in self.weights.items():
                self._search.add_word(gram, weight)
            self._search.make_automaton()
        whole = self.words(text)
        worst: dict[str, float] = {}
        for end, weight in self._search.iter(whole) if self._search else ():
            start = whole.rfind("<", 0, end + 1)
            word = whole[start : whole.find(">", start)]
            if weight > worst.get(word, 0.0):
                worst[word] = weight
        first = [*sorted(worst.values(), reverse=True)[:2], 0.0, 0.0]
        bad = sum(s > 2 * MIN_WEIGHT for s in worst.values())
        return [first[0], first[1], math.log1p(bad), math.log1p(whole.count("<"))]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.line is None:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(evidence @ self.line[:-1] + self.line[-1], -30, 30)))


def fit_line(evidence: np.ndarray, labels: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; weights and intercept."""
    x = np.column_stack((evidence, np.ones(len(evidence))))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (labels - p) - ridge * w)
    return w


def character_model(docs: DataFrame) -> CharacterModel | None:
    """The language model of all texts; None if none has a letter."""
    counts = langid.collected_counts(docs.select("text", F.lit("").alias("lang")))
    return CharacterModel(langid.estimate(counts)) if counts else None


def train(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """A scorer from the labelled rows of ``docs``; the caller leaves out what it holds back."""
    characters = character_model(docs)
    if characters is None:
        return None
    return learn(characters, docs, labels)


def learn(characters: CharacterModel, training: DataFrame, labels: DataFrame) -> Scorer:
    """Weights and line from the first ``TRAINING_TEXTS`` labelled rows by hash of the id."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashed = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_TEXTS)
    sample = training.select("doc_id", F.col("text").cast("string")).join(hashed, "doc_id")
    sample = sample.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    scorer = Scorer(characters)
    shipped = sample.sparkSession.sparkContext.broadcast(scorer)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[str, list[int]] = {}
        words: dict[str, list[str]] = {}
        for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            grams = {""}  # stands for the text itself
            for word in set(shipped.value.words(text)[1:-1].split("><")):
                if word not in words:
                    words[word] = grams_of(word)
                grams.update(words[word])
            for gram in grams:
                seen.setdefault(gram, [0, 0, 0, 0])[2 * half + bool(toxic)] += 1
        return record(
            gram=pa.array(list(seen), pa.string()), n=pa.array(list(seen.values()), pa.list_(pa.int64()))
        )

    counted = map_batches(sample.select("text", "toxic", "half"), count, "gram string, n array<long>")
    names = ("other0", "toxic0", "other1", "toxic1")
    counted = counted.groupBy("gram").agg(*[F.sum(F.get("n", F.lit(i))).alias(x) for i, x in enumerate(names)])
    toxic, other = F.col("toxic0") + F.col("toxic1"), F.col("other0") + F.col("other1")
    counted = counted.where((F.col("gram") == "") | (toxic >= MIN_TEXTS))
    # The first row counts the texts; then the n-grams with the most toxic texts for each other one.
    ratio = (toxic + 0.5) / (other + 0.5)
    rows = counted.orderBy((F.col("gram") == "").desc(), ratio.desc(), "gram").limit(MAX_WEIGHTS + 1).collect()
    if not rows or rows[0].gram:
        return scorer
    n = np.array([[r[x] for x in names] for r in rows], float)
    grams = [r.gram for r in rows]

    def weights(counts: np.ndarray) -> dict[str, float]:
        odds = np.log((counts[:, 1] + 0.5) / (counts[:, 0] + 0.5))
        odds -= np.log((counts[0, 1] + 1) / (counts[0, 0] + 1))
        return {g: w for g, w, k in zip(grams[1:], odds[1:].tolist(), counts[1:, 1], strict=True) if w >= MIN_WEIGHT and k >= MIN_TEXTS}

    if not n[0, [0, 2]].sum() or not n[0, [1, 3]].sum():
        return scorer
    crossed = [Scorer(characters, weights(n[:, :2])), Scorer(characters, weights(n[:, 2:]))]
    rows = _evidence(sample, crossed).collect()
    truth = np.array([r.toxic for r in rows], float)
    scorer.weights = weights(n[:, :2] + n[:, 2:])
    scorer.line = fit_line(np.array([r.evidence for r in rows]), truth)
    return scorer


def _evidence(sample: DataFrame, crossed: list[Scorer]) -> DataFrame:
    """(evidence, toxic) of each text by the scorer of the other half."""
    shipped = sample.sparkSession.sparkContext.broadcast(crossed)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, halves = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        found = [shipped.value[1 - half].evidence(t) for t, half in zip(texts, halves, strict=True)]
        return record(evidence=pa.array(found, pa.list_(pa.float64())), toxic=batch.column(1))

    return map_batches(sample.select("text", "toxic", "half"), of, "evidence array<double>, toxic int")


def scores(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """(doc_id, text_hash, score, predicted), a row for each row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(scorer)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shipped.value
        score = np.zeros(batch.num_rows)
        if own is not None:
            score = own.score(np.array([own.evidence(t) for t in batch.column(2).to_pylist()]))
        return record(
            doc_id=batch.column(0),
            text_hash=batch.column(1),
            score=pa.array(score),
            predicted=pa.array((score >= THRESHOLD).astype(np.int32)),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return map_batches(rows, of, "doc_id long, text_hash long, score double, predicted int")


def keep_clean(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; only the ids of those that go are moved."""
    bad = scores(docs, scorer).where("predicted = 1").select("doc_id", "text_hash").distinct()
    return docs.join(bad, alike(docs, bad), "left_anti")
