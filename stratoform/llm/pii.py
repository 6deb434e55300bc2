"""Personal data: exact patterns, and what a bidirectional LSTM with a CRF adds.

The patterns find e-mail addresses, IP addresses, card and phone numbers; their
spans always stay. A character-level tagger is trained in numpy on labelled
windows: kinds of characters are embedded, an LSTM reads each way, and a linear
chain CRF with learned transitions scores tag sequences (nothing, or one of the
four kinds). It reads every text whole, in windows of ``SIZE`` characters that
overlap; each window is decoded by Viterbi, every character takes its tag from
the window in whose middle it is, and spans are runs of a tag over the whole
text.

What it adds are spellings that the patterns miss: it is trained on windows
around the patterns' spans, once as they are and once with the span written
otherwise (``disguised``: "(at)" and "dot", spaced or bracketed points, card
numbers in other groups, phone numbers with 00 or slashes), and on what the
patterns refuse, as nothing. A run is added when the spelling around it, read
back, passes the kind's own rule (Luhn's sum, four parts up to 255, 9 to 15
digits, an address with a domain) and meets none of the patterns' spans.

Gates are piecewise linear, so that a step of many windows is a few vector
operations. Training takes at most ``TRAINING_WINDOWS`` windows, the first by
hash, and the seed is fixed, so reruns agree.

Places are code points, ends exclusive. Null text is empty; empty texts have
no spans. Repeated rows get a row each; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratoform.llm.common import map_batches, record

KINDS = ("email", "ip", "card", "phone")
SIZE, STRIDE = 128, 104
HIDDEN, EMBEDDED = 8, 6
TRAINING_WINDOWS = 1_500
STEPS, BATCH, RATE = 260, 48, 0.03
#: Characters that are turned into arrays at once, and windows that are read at once.
CHUNK, GROUP = 1_000_000, 8_192
#: Characters around a run, or a piece of a long one, in which its spelling may begin and end.
AROUND, PIECE = 24, 512
#: Disguised windows of each span by kind; addresses have the most spellings.
SPELLED = (12, 4, 4, 4)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    """Matches of the whole pattern: each @ with a domain, and all characters before it that fit."""
    found: list[Span] = []
    for m in _DOMAIN.finditer(text):
        start, free = m.start(), found[-1][1] if found else 0
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
    return found


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[list[Span]]:
    """The patterns' spans by kind; leftmost, not overlapping within a kind."""
    found = [_emails(text) if "@" in text else [], [], [], []]
    found[1] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    found[2] = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() > 12 and _is_card(m[0])]
    found[3] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return found


#: Spellings of a point and of the sign of an address, and what may part groups of digits.
_POINT = r"(?:\s*[\[({]\s*(?:\.|dot|DOT)\s*[\])}]\s*|\x20(?:\.|dot|DOT)\x20|\.)"
_AT = r"(?:\s*[\[({]\s*(?:@|at|AT)\s*[\])}]\s*|\x20(?:@|at|AT)\x20|@)"
_PARTED = r"(?:\x20?[-./_]\x20?|\x20{1,2})"
_SPELLINGS = (
    re.compile(rf"[A-Za-z0-9_%+-]+(?:{_POINT}[A-Za-z0-9_%+-]+)*{_AT}[A-Za-z0-9-]+(?:{_POINT}[A-Za-z0-9-]+)+"),
    re.compile(rf"[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}"),
    re.compile(rf"[0-9](?:{_PARTED}?[0-9]){{12,18}}"),
    re.compile(rf"(?:\+|00|\()[0-9](?:(?:{_PARTED}|[()/]|\x20?[()]\x20?)?[0-9]){{7,16}}"),
)


def _holds(kind: int, spelling: str) -> bool:
    """Whether a spelling, read back, passes the kind's own rule."""
    if kind == 0:
        plain = re.sub(_POINT, ".", re.sub(_AT, "@", spelling))
        return _emails(plain) == [(0, len(plain))]
    if kind == 1:
        parts = re.split(_POINT, spelling)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts)
    if kind == 2:
        return _is_card(spelling)
    # A bare number is no telephone number.
    return 9 <= len(_digits(spelling).removeprefix("00")) <= 15 and not spelling[1:].isdecimal()


def disguised(kind: int, span: str, pick: int) -> str:
    """A span as people write it who do not want it found; ``pick`` chooses the spelling."""
    if kind == 0:
        at = (" (at) ", " [at] ", " at ", "(at)", " @ ", "[at]")[pick % 6]
        point = (".", " dot ", " (dot) ", "[.]", " . ", "[dot]")[pick // 6 % 6]
        local, _, domain = span.rpartition("@")
        return local + at + domain.replace(".", point)
    if kind == 1:
        return span.replace(".", ("[.]", " . ", "(.)", " dot ")[pick % 4])
    digits = _digits(span)
    if kind == 2:
        parting = (".", "/", "_", "  ", " - ")[pick % 5]
        return parting.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    parting = ("/", " / ", ".", "-", " ")[pick % 5]
    return ("00", "00", "+")[pick % 3] + digits[:2] + parting + digits[2:5] + parting + digits[5:]


def _refused(text: str) -> list[Span]:
    """Matches of the patterns that their rules refuse; they teach the tagger what is nothing."""
    found = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() > 12 and not _is_card(m[0])]
    return found + [m.span() for m in _IP.finditer(text) if any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or "0") > 255 for p in m[0].split("."))]


_SIGNS = " \n@.-+()_%:/,[]"
_CLASSES = 6 + len(_SIGNS)
_TABLE: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """By code point the kind of character; 0 is beyond a text."""
    if not _TABLE:
        table = np.full(0x110000, 5, np.uint8)
        for plane in range(0, 0x110000, 0x1000):
            table[[c for c in range(plane, plane + 0x1000) if chr(c).isalpha()]] = 4
        table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1], table[ord("0") : ord("9") + 1] = 1, 2, 3
        for i, sign in enumerate(_SIGNS):
            table[ord(sign)] = 6 + i
        _TABLE.append(table)
    return _TABLE[0]


def codes_of(text: str) -> np.ndarray:
    return _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.2 * x + 0.5, 0, 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -1, 1)


class Tagger:
    """Embeddings, an LSTM each way, and a CRF over the tags."""

    def __init__(self, seed: int = 11, hidden: int = HIDDEN, embedded: int = EMBEDDED, tags: int = len(KINDS) + 1) -> None:
        rng = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        draw = lambda *shape: rng.normal(0, 0.4, shape)
        self.weights = {
            "embed": draw(_CLASSES, embedded),
            "input": draw(2, embedded, 4 * hidden),
            "state": draw(2, hidden, 4 * hidden) * 0.5,
            "bias": np.zeros((2, 4 * hidden)),
            "out": draw(2 * hidden, tags),
            "prior": np.zeros(tags),
            "move": np.zeros((tags, tags)),
            "start": np.zeros(tags),
        }
        self.weights["bias"][:, hidden : 2 * hidden] = 2.0  # remember at first

    # Training: arrays are (direction, window, place, feature); the second direction reads backwards.

    def _read(self, codes: np.ndarray) -> dict[str, np.ndarray]:
        w, h = self.weights, self.hidden
        x = w["embed"][codes]
        both = np.stack((x, x[:, ::-1]))
        pre = both @ w["input"][:, None] + w["bias"][:, None, None]
        count, size = codes.shape
        keep = {k: np.zeros((size, 2, count, h)) for k in ("i", "f", "o", "g", "c", "h", "s")}
        z = np.zeros((size, 2, count, 4 * h))
        state, cell = np.zeros((2, count, h)), np.zeros((2, count, h))
        for t in range(size):
            z[t] = pre[:, :, t] + state @ w["state"]
            gates = _gate(z[t][..., : 3 * h])
            i, f, o = gates[..., :h], gates[..., h : 2 * h], gates[..., 2 * h :]
            g = _squash(z[t][..., 3 * h :])
            cell = f * cell + i * g
            s = _squash(cell)
            state = o * s
            for k, v in zip(("i", "f", "o", "g", "c", "h", "s"), (i, f, o, g, cell, state, s), strict=True):
                keep[k][t] = v
        features = np.concatenate((keep["h"][:, 0], keep["h"][::-1, 1]), axis=-1)
        return keep | {"z": z, "both": both, "features": features, "emit": features @ w["out"] + w["prior"]}

    def loss(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tagged windows, and its gradients."""
        w, h = self.weights, self.hidden
        r = self._read(codes)
        count, size = codes.shape
        loss, d_emit, grads = self._chain(r["emit"], tags.T)
        scale = 1 / count
        d_emit *= scale
        grads = {k: v * scale for k, v in grads.items()}
        grads["out"] = np.einsum("tnf,tnk->fk", r["features"], d_emit)
        grads["prior"] = d_emit.sum((0, 1))
        d_features = d_emit @ w["out"].T
        d_h = np.stack((d_features[..., :h], d_features[::-1, :, h:]), axis=1)
        d_z = np.zeros_like(r["z"])
        d_state, d_cell = np.zeros((2, count, h)), np.zeros((2, count, h))
        for t in range(size - 1, -1, -1):
            d_state = d_state + d_h[t]
            d_cell = d_cell + d_state * r["o"][t] * (np.abs(r["c"][t]) < 1)
            before = r["c"][t - 1] if t else np.zeros_like(d_cell)
            d_gates = np.concatenate((d_cell * r["g"][t], d_cell * before, d_state * r["s"][t]), axis=-1)
            z = r["z"][t]
            d_z[t][..., : 3 * h] = d_gates * 0.2 * (np.abs(z[..., : 3 * h]) < 2.5)
            d_z[t][..., 3 * h :] = d_cell * r["i"][t] * (np.abs(z[..., 3 * h :]) < 1)
            d_cell = d_cell * r["f"][t]
            d_state = d_z[t] @ w["state"].transpose(0, 2, 1)
        grads["state"] = np.einsum("tdnh,tdng->dhg", r["h"][:-1], d_z[1:])
        grads["bias"] = d_z.sum((0, 2))
        grads["input"] = np.einsum("dnte,tdng->deg", r["both"], d_z)
        d_both = np.einsum("tdng,deg->dnte", d_z, w["input"])
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], codes, d_both[0] + d_both[1][:, ::-1])
        return loss * scale, grads

    def _chain(self, emit: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """Loss and gradients of the CRF; arrays are (place, window, tag)."""
        move, start = self.weights["move"], self.weights["start"]
        size, count, kinds = emit.shape
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[0] = start + emit[0]
        for t in range(1, size):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + emit[t]
        for t in range(size - 2, -1, -1):
            beta[t] = _log_sum(move + (emit[t + 1] + beta[t + 1])[:, None], 2)
        whole = _log_sum(alpha[-1], 1)
        marginal = np.exp(alpha + beta - whole[:, None])
        edge = alpha[:-1, :, :, None] + move + (emit + beta)[1:, :, None] - whole[:, None, None]
        place, window = np.arange(size)[:, None], np.arange(count)
        right = emit[place, window, tags].sum() + start[tags[0]].sum() + move[tags[:-1], tags[1:]].sum()
        d_emit = marginal
        d_start = marginal[0].sum(0)
        d_move = np.exp(edge).sum((0, 1))
        np.add.at(d_start, tags[0], -1)
        np.add.at(d_move, (tags[:-1], tags[1:]), -1)
        d_emit[place, window, tags] -= 1
        return float(whole.sum() - right), d_emit, {"move": d_move, "start": d_start}

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 12) -> Tagger:
        """Adam over batches of tagged windows, with a rate that falls to zero."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = rng.permutation(len(codes))
        for step in range(1, steps + 1):
            chosen = np.take(order, np.arange((step - 1) * BATCH, step * BATCH), mode="wrap")
            _, grads = self.loss(codes[chosen], tags[chosen])
            norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in grads.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                fair = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] -= rate * fair
        return self

    # Reading: arrays are (feature, window), so that every operation runs along the windows.

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tags of windows given as (place, window)."""
        size, count = codes.shape
        h, w = self.hidden, self.weights
        emit = np.empty((size, self.tags, count), np.float32)
        emit[:] = w["prior"].astype(np.float32)[None, :, None]
        for d, places in ((0, range(size)), (1, range(size - 1, -1, -1))):
            table = (w["embed"] @ w["input"][d] + w["bias"][d]).T.astype(np.float32).copy()
            table[: 3 * h] = 0.2 * table[: 3 * h] + 0.5
            recur = w["state"][d].T.astype(np.float32).copy()
            recur[: 3 * h] *= 0.2
            out = w["out"][d * h : (d + 1) * h].T.astype(np.float32).copy()
            state, cell = np.zeros((h, count), np.float32), np.zeros((h, count), np.float32)
            z, seen = np.empty((4 * h, count), np.float32), np.empty((4 * h, count), np.float32)
            part = np.empty((h, count), np.float32)
            for t in places:
                np.matmul(recur, state, out=z)
                np.take(table, codes[t], axis=1, out=seen, mode="clip")
                z += seen
                np.clip(z[: 3 * h], 0, 1, out=z[: 3 * h])
                np.clip(z[3 * h :], -1, 1, out=z[3 * h :])
                cell *= z[h : 2 * h]
                np.multiply(z[:h], z[3 * h :], out=part)
                cell += part
                np.clip(cell, -1, 1, out=part)
                np.multiply(z[2 * h : 3 * h], part, out=state)
                emit[t] += out @ state
        return self._best(emit)

    def _best(self, emit: np.ndarray) -> np.ndarray:
        """Viterbi over (place, tag, window)."""
        move = self.weights["move"].astype(np.float32)
        size, kinds, count = emit.shape
        back = np.zeros((size, kinds, count), np.uint8)
        score = emit[0] + self.weights["start"].astype(np.float32)[:, None]
        for t in range(1, size):
            after = emit[t].copy()
            for k in range(kinds):
                best = score[0] + move[0, k]
                choice = back[t, k]
                for j in range(1, kinds):
                    other = score[j] + move[j, k]
                    np.copyto(choice, j, where=other > best)
                    np.maximum(best, other, out=best)
                after[k] += best
            score = after
        tags = np.empty((size, count), np.uint8)
        tags[-1] = score.argmax(0)
        column = np.arange(count)
        for t in range(size - 1, 0, -1):
            tags[t - 1] = back[t, tags[t], column]
        return tags

    def tag(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Runs of tags (kind, start, end) of each text."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for first, group in _chunks(texts):
            lengths = np.array([len(t) for t in group])
            offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
            codes = np.zeros(offsets[-1] + SIZE, np.uint8)
            for offset, text in zip(offsets.tolist(), group, strict=False):
                codes[offset : offset + len(text)] = codes_of(text)
            tags = self._stitched(codes, offsets, lengths)
            edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
            kind = tags[edges[:-1]] if len(edges) else edges
            owner = np.searchsorted(offsets, edges, "right") - 1
            for a, b, k, o in zip(edges.tolist(), edges[1:].tolist(), kind.tolist(), owner.tolist(), strict=False):
                if k:
                    found[first + o].append((k - 1, a - int(offsets[o]), b - int(offsets[o])))
        return found

    def _stitched(self, codes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """One tag per character: of the window in whose middle it is."""
        counts = np.maximum(1, 1 + -(-(lengths - SIZE) // STRIDE)) * (lengths > 0)
        doc = np.repeat(np.arange(len(lengths)), counts)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = number * STRIDE
        margin = (SIZE - STRIDE) // 2
        low = np.where(number == 0, 0, margin)
        high = np.where(number == counts[doc] - 1, SIZE, STRIDE + margin)
        tags = np.zeros(len(codes), np.uint8)
        place = np.arange(SIZE)[:, None]
        for at in range(0, len(doc), GROUP):
            own = slice(at, at + GROUP)
            index = (offsets[doc[own]] + start[own])[None] + place
            inside = start[own] + place < lengths[doc[own]]
            window = self.decode(np.where(inside, codes[index], 0))
            take = inside & (place >= low[own]) & (place < high[own])
            tags[index[take]] = window[take]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if texts[first:]:
        yield first, texts[first:]


def labelled_windows(docs: DataFrame) -> DataFrame:
    """(window, tags): a tag for each character of windows around the patterns' spans, disguised spans and refused ones.

    This is the supervision when no spans are labelled by hand. Each text has
    a window anywhere as well. Its windows begin at places that its own hash
    picks, and so do the spellings.
    """

    def window(text: str, start: int, spans: list[tuple[int, int, int]]) -> tuple[str, str]:
        own = text[start : start + SIZE]
        tags = ["0"] * len(own)
        for a, b, k in spans:
            for p in range(max(a, start), min(b, start + len(own))):
                tags[p - start] = str(k)
        return own, "".join(tags)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows, tagged = [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            spans = sorted((a, b, k + 1) for k, own in enumerate(base_spans(text)) for a, b in own)
            pick = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "big")
            before = lambda a, n: max(0, a - (pick + 37 * n) % (SIZE // 2))  # noqa: B023, E731
            starts = {before(a, n) for n, (a, _) in enumerate([*((a, b) for a, b, _ in spans), *_refused(text)])}
            found = [window(text, start, spans) for start in sorted({*starts, pick % max(1, len(text) - SIZE)})]
            for n, (a, b, k) in enumerate(s for s in spans for _ in range(SPELLED[s[2] - 1])):
                start, spelling = before(a, n), disguised(k - 1, text[a:b], pick + 7 * n)
                around = [s for s in spans if s[1] <= a and s[1] > start]
                rewritten = text[start:a] + spelling + text[b : b + SIZE]
                moved = [(x - start, y - start, z) for x, y, z in around] + [(a - start, a - start + len(spelling), k)]
                found.append(window(rewritten[: a - start + len(spelling) + 16], 0, moved))
            windows += [w for w, _ in found]
            tagged += [t for _, t in found]
        return record(window=pa.array(windows, pa.string()), tags=pa.array(tagged, pa.string()))

    return map_batches(docs.select(F.col("text").cast("string")), of, "window string, tags string")


def train(labelled: DataFrame, windows: int = TRAINING_WINDOWS) -> Tagger | None:
    """A tagger from labelled windows; half with spans, as far as there are. None without any span."""
    order = [F.xxhash64("window"), "window", "tags"]
    has = F.col("tags").rlike("[1-9]")
    distinct = labelled.where("window <> ''").distinct()
    rows = distinct.where(has).orderBy(*order).limit(windows * 2 // 3).collect()
    if not rows:
        return None
    rows += distinct.where(~has).orderBy(*order).limit(windows // 3).collect()
    codes, tags = np.zeros((len(rows), SIZE), np.int64), np.zeros((len(rows), SIZE), np.int64)
    for i, r in enumerate(rows):
        codes[i, : len(r.window)] = codes_of(r.window)
        tags[i, : len(r.tags)] = np.frombuffer(r.tags.encode(), np.uint8) - ord("0")
    return Tagger().fit(codes, tags)


def _added(text: str, base: list[list[Span]], tagged: list[tuple[int, int, int]]) -> list[list[Span]]:
    """The spellings at the tagger's runs that pass their kind's rule and meet none of the patterns' spans."""
    taken = sorted(s for own in base for s in own)
    out: list[list[Span]] = [[] for _ in KINDS]
    # Spellings are short, so long runs are looked at in pieces; the rule may tell another kind than the run's.
    pieces = [(kind, p, min(b, p + PIECE)) for kind, a, b in tagged for p in range(a, b, PIECE)]
    for run, a, b in pieces:
        low = max(0, a - AROUND)
        for kind in sorted(range(len(KINDS)), key=lambda k: k != run):
            for m in _SPELLINGS[kind].finditer(text, low, min(len(text), b + AROUND)):
                x, y = m.span()
                cut = (x == low and low and text[x - 1].isalnum()) or (y == b + AROUND < len(text) and text[y].isalnum())
                if cut or x >= b or y <= a or not _holds(kind, m[0]):
                    continue
                if not any(p < y and x < q for p, q in taken):
                    out[kind].append((x, y))
                    taken.append((x, y))
    return out


def listed(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in sorted(own))


def all_spans(texts: list[str], tagger: Tagger | None) -> Iterator[tuple[list[list[Span]], list[list[Span]]]]:
    """(patterns' spans, all spans) of each text, by kind."""
    tagged = tagger.tag(texts) if tagger else [[] for _ in texts]
    for text, runs in zip(texts, tagged, strict=True):
        base = base_spans(text)
        added = _added(text, base, runs) if runs else [[] for _ in KINDS]
        yield base, [sorted(x + y) for x, y in zip(base, added, strict=True)]


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row for each row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(tagger)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        found = list(all_spans(texts, shipped.value))
        counts = {f"n_{kind}": pa.array([len(b[k]) for b, _ in found], pa.int64()) for k, kind in enumerate(KINDS)}
        return record(
            doc_id=batch.column(0),
            **counts,
            base_sha256=pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in found], pa.string()),
            spans=pa.array([listed(a) for _, a in found], pa.string()),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_batches(rows, of, f"doc_id long, {schema}, base_sha256 string, spans string")


def redacted(text: str, spans: list[list[Span]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first span in brackets."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, own in enumerate(spans) for a, b in own):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with personal data replaced; ``n_chars``, if there is such a column, follows the text."""
    shipped = docs.sparkSession.sparkContext.broadcast(tagger)
    names = docs.columns
    at = names.index("text")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        found = all_spans([t or "" for t in texts], shipped.value)
        new = [None if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, found, strict=True)]
        columns = {name: batch.column(k) for k, name in enumerate(names)}
        return record(**columns | {"text": pa.array(new, pa.string())})

    out = map_batches(docs, of, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
