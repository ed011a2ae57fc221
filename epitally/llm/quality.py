"""Quality rules: an n-gram classifier with calibrated probabilities, and fixed rules.

The classifier is a logistic regression on hashed n-grams: single words and word pairs, and
runs of 2 to 4 characters inside a text, each group as shares that add up to one. It is trained
with numpy on the driver from a bounded number of labelled rows of each kind. Tasks count the
n-grams of their whole texts, and only these sparse counts reach the driver. A part of the sample
that training does not see calibrates the score to a probability (Platt scaling), with weights
that restore how common either kind is. The weights are one array of ``DIMENSIONS`` numbers, so
what is sent to the tasks does not grow with the data. Scoring works on whole texts in Arrow
batches, with array operations over all characters of a slice; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import (
    hash_pair,
    mixed,
    slices,
    smallest_hashes,
    span_hashes,
    text_bytes,
    word_spans,
)
from epitally.workspace import discard, written

DIMENSIONS = 1 << 18
CHARACTER_RUNS = (2, 3, 4)
# Bound of the training sample: different labelled rows of each kind.
SAMPLE_ROWS = 1_000
ROUNDS = 80
STEP = 64
# Bytes of text scored at once; the arrays over its characters take some fifty times as much.
PIECE_BYTES = 1 << 18
PENALTY = 1e-5
# Fixed thresholds of the rules.
LEAST_WORDS = 50
MOST_REPEATED = 0.5
LEAST_PROBABILITY = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BREAK = ord("\n")


@dataclass(frozen=True)
class QualityModel:
    """Weights of the hashed n-grams (words first, characters second), bias, calibration."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0


def _word_features(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and pairs, and how many features come before each text."""
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = mixed(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words[:0]
    same = text_of[:-1] == text_of[1:] if len(words) > 1 else np.zeros(0, bool)
    mask = np.uint64(DIMENSIONS // 2 - 1)
    hashed = np.concatenate([words, pairs[same]]) & mask
    owner = np.concatenate([text_of, text_of[:-1][same]])
    return hashed.astype(np.int64), owner


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of valid UTF-8 bytes as numbers, and where each text begins among them."""
    begins = (data & 0xC0) != 0x80
    if begins.all():
        return data.astype(np.uint32), offsets
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum(begins, out=count[1:])
    at = np.flatnonzero(begins)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    lead = padded[at]
    out = np.where(lead < 0x80, lead, 0)
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        own = np.flatnonzero((lead >= low) & (lead < (low >> 1 | 0x80)))
        value = lead[own] & mask
        for i in range(1, size):
            value = value << np.uint32(6) | padded[at[own] + i] & 0x3F
        out[own] = value
    return out, count[offsets]


def _run_features(points: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of ``n`` characters at every place, and which of them lie inside a text."""
    places = len(points) - n + 1
    if places <= 0:
        return np.empty(0, np.int64), np.empty(0, bool)
    h = np.full(places, n, np.uint32)
    for i in range(n):
        h *= np.uint32(0x01000193)
        h += points[i : i + places]
    h *= np.uint32(0x85EBCA6B)
    inside = np.ones(places, bool)
    for back in range(1, n):
        cut = offsets[1:-1] - back
        inside[cut[(cut >= 0) & (cut < places)]] = False
    return (h >> np.uint32(15)).astype(np.int64), inside


def raw_scores(data: np.ndarray, offsets: np.ndarray, model: QualityModel) -> np.ndarray:
    """The uncalibrated score of every text of a slice."""
    n = len(offsets) - 1
    half = DIMENSIONS // 2
    starts, ends, first = word_spans(data, offsets)
    hashed, owner = _word_features(span_hashes(data, starts, ends), first)
    total = np.bincount(owner, model.weights[:half][hashed], minlength=n)
    score = total / np.maximum(np.bincount(owner, minlength=n), 1)
    sums, counts = np.zeros(n), np.zeros(n)
    points, begins = code_points(data, offsets)
    for k in CHARACTER_RUNS:
        hashed, inside = _run_features(points, begins, k)
        running = np.zeros(len(hashed) + 1)
        np.cumsum(np.where(inside, model.weights[half:][hashed], 0), out=running[1:])
        last = np.clip(begins[1:] - k + 1, 0, len(hashed))
        begin = np.minimum(begins[:-1], last)
        sums += running[last] - running[begin]
        counts += last - begin
    return score + sums / np.maximum(counts, 1) + model.bias


def probabilities(raw: np.ndarray, model: QualityModel) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * raw + model.shift, -40, 40)))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and shares of the n-grams of a whole text."""
    data, offsets = text_bytes(pa.array([text], pa.string()))
    starts, ends, first = word_spans(data, offsets)
    words, _ = _word_features(span_hashes(data, starts, ends), first)
    points, begins = code_points(data, offsets)
    runs = np.concatenate([_run_features(points, begins, k)[0] for k in CHARACTER_RUNS])
    columns, shares = [], []
    for base, found in ((0, words), (DIMENSIONS // 2, runs)):
        column, count = np.unique(found, return_counts=True)
        columns.append((column + base).astype(np.int32))
        shares.append((count / max(1, len(found))).astype(np.float32))
    return np.concatenate(columns), np.concatenate(shares)


def fit(
    texts: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    weights: np.ndarray | None = None,
) -> QualityModel:
    """Train on the :func:`features` of four of five texts, calibrate on those of the fifth.

    ``weights`` say how many rows each text stands for when calibrating. With labels of one
    kind only, or none, the model says that kind (or "good") for all.
    """
    labels = np.asarray(labels, float)
    weights = np.ones(len(labels)) if weights is None else np.asarray(weights, float)
    if len(set(labels.tolist())) < 2:
        sure = 1.0 if not len(labels) or labels[0] else -1.0
        return QualityModel(np.zeros(DIMENSIONS, np.float32), sure, 10.0, 0.0)
    held = np.arange(len(texts)) % 5 == 4
    if len(set(labels[~held].tolist())) < 2:
        held[:] = False
    train = [t for t, h in zip(texts, held) if not h]
    y = labels[~held]
    n = len(train)
    # Both kinds weigh the same, however rare one is; calibration restores the shares.
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / n
    w, bias = np.zeros(DIMENSIONS), 0.0
    m, v, mb, vb = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        g, gb = PENALTY * w, 0.0
        # Some texts at a time, so that the driver holds little beside the counts themselves.
        for a in range(0, n, STEP):
            part = train[a : a + STEP]
            column = np.concatenate([c for c, _ in part])
            value = np.concatenate([v for _, v in part])
            row = np.repeat(np.arange(len(part)), [len(c) for c, _ in part])
            raw = np.bincount(row, value * w[column], minlength=len(part)) + bias
            wrong = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y[a : a + STEP]
            error = wrong * weight[a : a + STEP]
            g += np.bincount(column, value * error[row], minlength=DIMENSIONS)
            gb += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.3 * (m / a) / (np.sqrt(v / b) + 1e-9)
        bias -= 0.3 * (mb / a) / (np.sqrt(vb / b) + 1e-9)
    if not held.any():
        return QualityModel(w.astype(np.float32), float(bias))
    raw = np.array([v @ w[c] + bias for (c, v), h in zip(texts, held) if h])
    slope, shift = _platt(raw, labels[held], weights[held])
    return QualityModel(w.astype(np.float32), float(bias), slope, shift)


def _platt(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through scores and labels, with smoothed targets."""
    good, bad = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + shift, -40, 40)))
        d, s = (p - target) * weight, p * (1 - p) * weight + 1e-9
        g = np.array([(d * raw).sum(), d.sum()])
        h = np.array([[(s * raw * raw).sum(), (s * raw).sum()], [(s * raw).sum(), s.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(shift)


def _counted(sample: DataFrame) -> DataFrame:
    """``(place, label, columns, shares)`` of the texts of a sample, the arrays as bytes."""
    schema = "place long, label int, columns binary, shares binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE_BYTES):
                found = [features(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("place"),
                        part.column("label"),
                        pa.array([c.tobytes() for c, _ in found], pa.binary()),
                        pa.array([v.tobytes() for _, v in found], pa.binary()),
                    ],
                    names=["place", "label", "columns", "shares"],
                )

    return sample.select("place", "label", "text").mapInArrow(run, schema)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit on at most ``rows`` different labelled documents of each kind, by a hash of key and text.

    Labels other than 0 and 1 and rows with a null key, label or text are not learned from; a
    document labelled twice counts with its greatest label. Rows that agree in key and text are
    one, however often they occur, and labels without a document take no place in the sample.
    Whole texts are learned from.

    Hashes of the labelled texts are ranked first; the texts of the sample alone are then read.
    How common each kind is, is counted over all different labelled rows.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("label"))
    texts = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(text).alias("text"), *[
            h.alias(f"h{i}") for i, h in enumerate(hash_pair(F.col(key), F.col(text)))
        ]
    )
    # Equal rows are one before the join, so that no key is hot in it.
    labelled = texts.select("k", "h0", "h1").distinct().join(known, "k").select("h0", "h1", "label")
    labelled = written(labelled, "labelled")
    counts = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    sample = written(smallest_hashes(labelled, "label", rows), "sample")
    # At most ``rows`` hashes of each kind.
    found = texts.join(F.broadcast(sample), ["h0", "h1"]).dropDuplicates(["h0", "h1"])
    found = _counted(found.withColumnRenamed("h0", "place")).toPandas().sort_values("place")
    discard(docs.sparkSession, labelled, sample)
    arrays = [
        (np.frombuffer(c, np.int32), np.frombuffer(v, np.float32))
        for c, v in zip(found["columns"], found["shares"])
    ]
    y = found["label"].to_numpy()
    drawn = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    total = sum(counts.values())
    weights = np.array([counts[k] / total * len(y) / drawn[k] for k in y])
    return fit(arrays, y, weights)


def rule_counts(part: pa.Array) -> tuple[np.ndarray, ...]:
    """Words, their characters, symbols, repeated lines and words in repeated windows."""
    data, offsets = text_bytes(part)
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)

    def inside(marks: np.ndarray) -> np.ndarray:
        running = np.zeros(len(data) + 1, np.int64)
        np.cumsum(marks, out=running[1:])
        return running

    characters = inside((data & 0xC0) != 0x80)
    word_chars = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(characters[ends] - characters[starts], out=word_chars[1:])
    symbols = inside(_SYMBOL[data])

    words = span_hashes(data, starts, ends)
    text_of = np.repeat(np.arange(n), n_words)
    repeated = np.zeros(len(words), bool)
    if len(words) >= 3:
        whole = text_of[:-2] == text_of[2:]
        windows = mixed(mixed(mixed(words[:-2]) + words[1:-1]) + words[2:])
        windows = mixed(windows + text_of[:-2].astype(np.uint64))[whole]
        at = np.flatnonzero(whole)
        order = np.argsort(windows, kind="stable")
        ordered = windows[order]
        twin = np.zeros(len(ordered), bool)
        equal = ordered[1:] == ordered[:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
        found = at[order[twin]]
        for i in range(3):
            repeated[found + i] = True
    repeats = np.bincount(text_of[repeated], minlength=n)

    lines = np.zeros(n, np.int64)
    view = data.tobytes()
    for i in range(n):
        seen: set[bytes] = set()
        for line in view[offsets[i] : offsets[i + 1]].split(b"\n"):
            if line in seen:
                lines[i] += 1
            elif line and not line.isspace():
                seen.add(line)
    return (
        n_words,
        word_chars[first[1:]] - word_chars[first[:-1]],
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        lines,
        repeats,
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with the rules' counts, ``quality`` (a probability), ``base_failed`` and ``kept``.

    A null text counts as empty and fails. Columns already named like the added ones are
    replaced. Rows are judged one by one: equal rows alike, an empty table stays empty.
    """
    added = [T.StructField(c, T.LongType()) for c in COUNTS]
    added += [
        T.StructField("quality", T.DoubleType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
    docs = docs.drop(*[f.name for f in added])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES):
                counts = rule_counts(part.column(text))
                data, offsets = text_bytes(part.column(text))
                quality = probabilities(raw_scores(data, offsets, own), own)
                failed = (counts[0] < LEAST_WORDS) | (counts[4] > MOST_REPEATED * counts[0])
                kept = ~failed & (quality >= LEAST_PROBABILITY)
                columns = [pa.array(c.astype(np.int64)) for c in counts]
                columns += [pa.array(quality), pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns],
                    names=[*part.schema.names, *[f.name for f in added]],
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
