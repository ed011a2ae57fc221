"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a window of bytes in both directions and labels every position. A window is
one word (a run without ASCII white space, A-Z in lower case) between two boundary bytes; a
run longer than ``WINDOW`` bytes is cut into several. The network's state starts anew in each
window, so equal windows have equal results wherever they stand, and a task keeps a bounded
memo of them: every byte of every text is labelled, but a word met before costs a look-up. A
document's probabilities are the mean over all its positions.

Training runs in numpy on the driver, by backpropagation through time. Every language is
learned, from a bounded number of different texts and of windows of each text; the windows are
drawn in tasks from whole texts, and only they reach the driver. What that holds, and the
network sent to tasks, grows with the number of languages, not with the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import (
    hash_pair,
    slices,
    smallest_hashes,
    span_hashes,
    text_bytes,
    word_spans,
)
from epitally.workspace import discard, written

UNKNOWN = "und"
HIDDEN = 16
WINDOW = 24
# Bounds of the training sample for each language: different texts, and windows learned from.
SAMPLE_ROWS = 300
SAMPLE_WINDOWS = 24_000
# Windows drawn from one text, evenly over all of it.
TEXT_WINDOWS = 400
EPOCHS = 3
BATCH = 256
# Windows a task remembers before it starts anew.
MEMO = 1_000_000
# Windows that go through the network at once.
CHUNK = 16_384

_EDGE = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = regex.compile(r"\p{L}").search


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the network's arrays by name; no language: nothing was learned."""

    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_weights(languages: int, hidden: int = HIDDEN, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random arrays: for each direction byte inputs and recurrence (update, reset,
    candidate side by side), and the output layer over both."""
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        w[f"h{d}"] = rng.normal(0, 0.6 / np.sqrt(hidden), (hidden, 3 * hidden))
        w[f"c{d}"] = np.zeros(3 * hidden)
    w["o"] = rng.normal(0, 0.6 / np.sqrt(2 * hidden), (2 * hidden, languages))
    w["b"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _read(w: dict, d: str, x: np.ndarray, valid: np.ndarray, keep: list | None) -> np.ndarray:
    """States after every position of ``x`` (positions, windows) in the order given.

    Where ``valid`` is false the state stays as it is. ``keep`` collects what the way back needs.
    """
    hidden = w[f"h{d}"].shape[0]
    table = w[f"x{d}"] + w[f"c{d}"]
    h = np.zeros((x.shape[1], hidden), np.float32)
    out = np.empty((*x.shape, hidden), np.float32)
    for t in range(len(x)):
        given = table[x[t]]
        back = h @ w[f"h{d}"]
        zr = _sigmoid(given[:, : 2 * hidden] + back[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        n = np.tanh(given[:, 2 * hidden :] + r * back[:, 2 * hidden :])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((h, z, r, n, back[:, 2 * hidden :]))
        h = np.where(valid[t][:, None], new, h)
        out[t] = h
    return out


def position_probabilities(w: dict, x: np.ndarray, valid: np.ndarray, keep=None) -> np.ndarray:
    """Probabilities of every language at every position of every window."""
    kf, kb = (None, None) if keep is None else keep
    forward = _read(w, "f", x, valid, kf)
    backward = _read(w, "b", x[::-1], valid[::-1], kb)[::-1]
    both = np.concatenate([forward, backward], axis=2)
    logits = both @ w["o"] + w["b"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    return p if keep is None else (p, both)


def gradients(w: dict, x: np.ndarray, valid: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over positions, and its gradient by backpropagation through time."""
    kf, kb = [], []
    p, both = position_probabilities(w, x, valid, (kf, kb))
    windows = np.arange(x.shape[1])
    count = max(1, int(valid.sum()))
    loss = -(np.log(p[:, windows, label] + 1e-12) * valid).sum() / count
    d = p.copy()
    d[:, windows, label] -= 1
    d *= (valid / count)[:, :, None]
    g = {"o": np.tensordot(both, d, ((0, 1), (0, 1))), "b": d.sum((0, 1))}
    states = d @ w["o"].T
    hidden = w["hf"].shape[0]
    for name, kept, xs, ok, ds in (
        ("f", kf, x, valid, states[:, :, :hidden]),
        ("b", kb, x[::-1], valid[::-1], states[::-1, :, hidden:]),
    ):
        gx, gh = np.zeros_like(w[f"x{name}"]), np.zeros_like(w[f"h{name}"])
        gc = np.zeros_like(w[f"c{name}"])
        later = np.zeros_like(kept[0][0])
        for t in range(len(xs) - 1, -1, -1):
            h, z, r, n, back = kept[t]
            dh = later + ds[t]
            here = ok[t][:, None]
            dn = dh * (1 - z) * (1 - n * n) * here
            dz = dh * (h - n) * z * (1 - z) * here
            dr = dn * back * r * (1 - r)
            given = np.concatenate([dz, dr, dn], axis=1)
            through = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(gx, xs[t], given)
            gc += given.sum(0)
            gh += h.T @ through
            later = np.where(here, dh * z + through @ w[f"h{name}"].T, dh)
        g[f"x{name}"], g[f"h{name}"], g[f"c{name}"] = gx, gh, gc
    return float(loss), g


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows, and the first window of each text."""
    starts, ends, first = word_spans(data, offsets)
    pieces = np.maximum(1, -(-(ends - starts) // WINDOW))
    if len(pieces) and pieces.max() > 1:
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(starts, pieces) + inner * WINDOW
        stop = np.minimum(begin + WINDOW, np.repeat(ends, pieces))
        whole = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(pieces, out=whole[1:])
        return begin, stop, whole[first]
    return starts, ends, first


def padded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (positions, windows) with a boundary byte on either side, and which are valid."""
    lengths = ends - starts
    longest = int(lengths.max()) if len(lengths) else 0
    at = np.arange(-1, longest + 1)[:, None]
    inside = (at >= 0) & (at < lengths)
    x = np.where(inside, data[np.where(inside, starts + at, 0)], _EDGE) if len(data) else None
    return x, at <= lengths


def drawn_windows(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text up to ``TEXT_WINDOWS`` of its windows, evenly over it: a row each, with the
    length first and then the bytes, padded."""
    data = _LOWER[data]
    starts, ends, first = windows_of(data, offsets)
    out = []
    for a, b in zip(first, first[1:]):
        at = np.arange(a, b)
        if b - a > TEXT_WINDOWS:
            at = a + (np.arange(TEXT_WINDOWS) * (b - a)) // TEXT_WINDOWS
        lengths = (ends - starts)[at]
        rows = np.zeros((len(at), WINDOW + 1), np.uint8)
        rows[:, 0] = lengths
        place = np.arange(WINDOW)
        inside = place < lengths[:, None]
        rows[:, 1:][inside] = data[(starts[at][:, None] + place)[inside]]
        out.append(rows)
    return out


def fit(texts: dict[str, list[str]], epochs: int = EPOCHS, seed: int = 7) -> LanguageModel:
    """Train on texts by language, on windows that :func:`drawn_windows` takes of each."""
    found = {}
    for name, some in texts.items():
        drawn = drawn_windows(*text_bytes(pa.array(some, pa.string())))
        found[name] = np.concatenate([np.zeros((0, WINDOW + 1), np.uint8), *drawn])
    return fit_windows(found, epochs, seed)


def fit_windows(
    windows: dict[str, np.ndarray], epochs: int = EPOCHS, seed: int = 7
) -> LanguageModel:
    """Train on windows by language, of each a random ``SAMPLE_WINDOWS``, repeated if there are
    fewer, so that a rare language counts as much as a common one."""
    languages = tuple(sorted(k for k, v in windows.items() if len(v)))
    if not languages:
        return LanguageModel((), {})
    rng = np.random.default_rng(seed)
    taken, labels = [], []
    for i, name in enumerate(languages):
        have = windows[name]
        take = rng.choice(len(have), SAMPLE_WINDOWS, replace=len(have) < SAMPLE_WINDOWS)
        taken.append(have[take])
        labels.append(np.full(SAMPLE_WINDOWS, i))
    rows, label = np.concatenate(taken), np.concatenate(labels)
    begin = np.arange(len(rows)) * (WINDOW + 1) + 1
    stop = begin + rows[:, 0]
    data = rows.ravel()
    w = new_weights(len(languages), seed=seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    step, steps = 0, epochs * -(-len(label) // BATCH)
    for _ in range(epochs):
        # Windows of like length side by side, batches in random order.
        noise = rng.random(len(label))
        order = np.lexsort((noise, stop - begin))
        batches = np.array_split(order, -(-len(order) // BATCH))
        for i in rng.permutation(len(batches)):
            own = batches[i]
            x, valid = padded(data, begin[own], stop[own])
            _, g = gradients(w, x, valid, label[own])
            step += 1
            rate = 0.01 * (1 - step / (steps + 1)) + 1e-4
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.995 * v[k] + 0.005 * g[k] ** 2
                a, b = 1 - 0.9**step, 1 - 0.995**step
                w[k] = (w[k] - rate * (m[k] / a) / (np.sqrt(v[k] / b) + 1e-8)).astype(np.float32)
    return LanguageModel(languages, w)


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _drawn(sample: DataFrame) -> DataFrame:
    """``(lang, place, windows)`` of the texts of a sample, the windows as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = drawn_windows(*text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"),
                        part.column("place"),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["lang", "place", "windows"],
                )

    return sample.select("lang", "place", "text").mapInArrow(
        run, "lang string, place long, windows binary"
    )


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS
) -> LanguageModel:
    """Fit on rows with a key, a text and a language, none of them held out.

    Every language is learned, from ``rows`` different texts of it, those with the smallest
    hash; a language with fewer gives all of them. Equal texts of a language are one, however
    often they occur, so neither copies nor common languages take the place of others. Texts
    without a word are not learned from. Whole texts take part; see :func:`drawn_windows`.

    Hashes are ranked first; the texts of the sample alone are then read again.
    """
    known = docs.where(
        ~held_out(F.col(key)) & F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull()
    )
    known = known.where(F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    known = known.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        *[h.alias(f"h{i}") for i, h in enumerate(hash_pair(F.col(lang), F.col(text)))],
    )
    different = written(known.select("lang", "h0", "h1").distinct(), "different")
    sample = written(smallest_hashes(different, "lang", rows).select("h0", "h1"), "sample")
    texts = known.join(sample, ["h0", "h1"]).dropDuplicates(["h0", "h1"])
    found = _drawn(texts.withColumnRenamed("h0", "place")).toPandas().sort_values(["lang", "place"])
    discard(docs.sparkSession, different, sample)
    return fit_windows(
        {
            name: np.concatenate(
                [np.frombuffer(w, np.uint8).reshape(-1, WINDOW + 1) for w in group]
            )
            for name, group in found.groupby("lang", sort=True)["windows"]
        }
    )


class _Labeller:
    """The network over all windows of a slice, with a memo of windows by hash."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.row_of: dict[int, int] = {}
        self.sums = np.empty((0, len(model.languages)), np.float32)

    def _network(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Probabilities summed over the positions of each window."""
        out = np.empty((len(starts), len(self.model.languages)), np.float32)
        order = np.argsort(ends - starts, kind="stable")
        for at in range(0, len(order), CHUNK):
            own = order[at : at + CHUNK]
            x, valid = padded(data, starts[own], ends[own])
            p = position_probabilities(self.model.weights, x, valid)
            out[own] = (p * valid[:, :, None]).sum(0)
        return out

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros without a window."""
        data = _LOWER[data]
        starts, ends, first = windows_of(data, offsets)
        n = len(offsets) - 1
        if not len(starts):
            return np.zeros((n, len(self.model.languages)))
        hashes = span_hashes(data, starts, ends)
        unique, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.row_of) + len(unique) > MEMO:
            self.row_of.clear()
            self.sums = self.sums[:0]
        keys = unique.tolist()
        fresh = np.array([k not in self.row_of for k in keys])
        at = sample[fresh]
        if len(at):
            found = self._network(data, starts[at], ends[at])
            base = len(self.row_of)
            self.row_of.update(zip(unique[fresh].tolist(), range(base, base + len(at))))
            if base + len(at) > len(self.sums):
                grown = np.empty((2 * (base + len(at)), found.shape[1]), np.float32)
                grown[:base] = self.sums[:base]
                self.sums = grown
            self.sums[base : base + len(at)] = found
        rows = np.array([self.row_of[k] for k in keys])[inverse]
        running = np.zeros((len(rows) + 1, self.sums.shape[1]))
        np.cumsum(self.sums[rows], axis=0, out=running[1:])
        positions = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(ends - starts + 2, out=positions[1:])
        total = positions[first[1:]] - positions[first[:-1]]
        return (running[first[1:]] - running[first[:-1]]) / np.maximum(total, 1)[:, None]


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    Only the text is looked at, and all of it. A null text, one without a letter, or a model
    that has learned nothing give ``und`` with score 0. Equal texts are labelled alike; an
    empty table stays empty. Columns of the two names are replaced. No shuffle.
    """
    docs = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        labeller = _Labeller(own)
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(text)
                known = np.array([t is not None and bool(_LETTER(t)) for t in column.to_pylist()])
                names, scores = [UNKNOWN] * len(known), np.zeros(len(known))
                if own.languages:
                    pooled = labeller.pooled(*text_bytes(column))
                    best = pooled.argmax(1)
                    scores = np.where(known, pooled[np.arange(len(best)), best], 0.0)
                    names = [own.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))],
                    names=[*part.schema.names, "lang_pred", "score"],
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
