"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are character shares of the line itself
and of the lines before and after it, counted on the UTF-8 bytes of whole Arrow
batches. The field is fitted on a bounded sample of labelled documents: first
with the document's label on every line, then once more after lines of bad
documents that look good have been relabelled. A document's quality is the mean
marginal probability of its lines being good, weighted by length, and calibrated
against the labels of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainstrata.llm.columns import held_out, in_small_batches

SAMPLE = 3000
THRESHOLD = 0.3
STEPS = 150
CHUNK = 1 << 20

# Byte classes: lower case (with all non-ASCII bytes), upper case, digits, blanks,
# sentence signs, exclamation marks, bars, other signs.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, *range(9, 14)]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[ord("!")] = 5
_CLASS[ord("|")] = 6
_OWN = 13
# Any odd number: words are told apart by a polynomial in it modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
FEATURES = 3 * _OWN + 2


def cut_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line in ``data`` and the number of lines of each text (an empty text has one)."""
    breaks = np.flatnonzero(data[offsets[0]:offsets[-1]] == 10) + offsets[0]
    per_text = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    starts, ends = np.empty(per_text.sum(), np.int64), np.empty(per_text.sum(), np.int64)
    inner = np.ones(len(starts), bool)
    inner[first] = False
    starts[first], starts[inner] = offsets[:-1], breaks + 1
    inner[:] = True
    inner[first + per_text - 1] = False
    ends[first + per_text - 1], ends[inner] = offsets[1:], breaks
    return starts, ends, per_text


def repeated_words(data: np.ndarray, blank: np.ndarray, line_starts: np.ndarray, line_ends: np.ndarray) -> np.ndarray:
    """Share of each line's words that equal the word before them in the line."""
    edge = np.diff(np.concatenate(([1], blank.view(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(len(line_starts))
    power = np.full(len(data) + 1, _BASE)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * power[:-1], out=sums[1:])
    power[0], power[1:] = 1, _INVERSE
    np.cumprod(power, out=power)
    word = (sums[ends] - sums[starts]) * power[starts]
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (np.diff(ends - starts) == 0)))
    first, stop = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    same[first[first < stop]] = False
    running = np.concatenate(([0], np.cumsum(same)))
    return (running[stop] - running[first]) / np.maximum(stop - first, 1)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, lines per text) of texts lying in a byte buffer."""
    starts, ends, per_text = cut_lines(data, offsets)
    lo, hi = offsets[0], offsets[-1]
    kinds = _CLASS[data[lo:hi]]
    counts = np.empty((8, len(starts)))
    running = np.zeros(hi - lo + 1, np.int64)
    for k in range(8):
        np.cumsum(kinds == k, out=running[1:])
        counts[k] = running[ends - lo] - running[starts - lo]
    length = (ends - starts).astype(float)
    size, letters = np.maximum(length, 1), np.maximum(counts[0] + counts[1], 1)
    last = np.where(ends > starts, data[np.maximum(ends - 1, lo)] if hi > lo else 0, 0)
    own = np.stack([
        np.log1p(length) / 8, counts[1] / letters, counts[2] / size, counts[3] / size, counts[4] / size, counts[5] / size,
        counts[6] / size, counts[7] / size, letters / (counts[3] + 1) / 10, np.isin(last, (33, 46, 63)), length == 0,
        (counts[7] + counts[5] + counts[6]) / (counts[3] + 1),
        repeated_words(data[lo:hi], kinds == 3, starts - lo, ends - lo)], axis=1)
    out = np.zeros((len(starts), FEATURES))
    out[:, :_OWN] = own
    head = np.zeros(len(starts), bool)
    head[np.cumsum(per_text) - per_text] = True
    tail = np.roll(head, -1)
    out[1:, _OWN:2 * _OWN] = own[:-1]
    out[:-1, 2 * _OWN:3 * _OWN] = own[1:]
    out[head, _OWN:2 * _OWN] = 0
    out[tail, 2 * _OWN:3 * _OWN] = 0
    out[:, -2], out[:, -1] = head, tail
    return out, length, per_text


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), offsets


def parts(column: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``chunk`` bytes, at least one row each."""
    _, offsets = buffers(column)
    at = 0
    while at < len(column):
        to = max(int(np.searchsorted(offsets, offsets[at] + chunk, side="right")) - 1, at + 1)
        yield at, min(to, len(column))
        at = to


@dataclass
class Field:
    """Weights of the field: the state "good" scores ``weights . x + bias``; ``moves[i, j]`` scores state i before j."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float
    shift: float


class Chains:
    """Sequences of different lengths side by side: step t of all sequences that have one."""

    def __init__(self, per_text: np.ndarray):
        order = np.argsort(-per_text, kind="stable")
        lengths = per_text[order]
        first = (np.cumsum(per_text) - per_text)[order]
        alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        self.steps = [first[:n] + t for t, n in enumerate(alive.tolist())]

    def marginals(self, score: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and expected moves summed over all neighbours (2 x 2)."""
        odds = np.exp(np.clip(score, -30, 30))
        step = np.exp(np.clip(moves, -15, 15))
        forward = np.empty((len(score), 2))
        backward = np.ones((len(score), 2))
        expected = np.zeros((2, 2))
        for t, at in enumerate(self.steps):
            now = forward[self.steps[t - 1][:len(at)]] @ step if t else np.ones((len(at), 2))
            now[:, 1] *= odds[at]
            forward[at] = now / now.sum(1, keepdims=True)
        for t in range(len(self.steps) - 1, 0, -1):
            at, before = self.steps[t], self.steps[t - 1][:len(self.steps[t])]
            reach = backward[at]
            reach[:, 1] *= odds[at]
            back = reach @ step.T
            pairs = forward[before][:, :, None] * step * reach[:, None, :]
            expected += (pairs / pairs.sum((1, 2), keepdims=True)).sum(0)
            backward[before] = back / back.sum(1, keepdims=True)
        both = forward * backward
        return both[:, 1] / both.sum(1), expected


def _weighted(good: np.ndarray, length: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    first = np.cumsum(per_text) - per_text
    weight = length + 1
    return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first) if len(per_text) else np.empty(0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _climb(gradient, start: np.ndarray, steps: int, rate: float = 0.1) -> np.ndarray:
    """Adam on a gradient function."""
    at, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for i in range(1, steps + 1):
        g = gradient(at)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        at -= rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-9)
    return at


def fit(x: np.ndarray, length: np.ndarray, per_text: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Field:
    """Fit on lines of whole documents; ``label`` is 1 for good documents. No rows: every score is 0.5."""
    if not len(label):
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, np.zeros((2, 2)), 0.0, 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    chains, n = Chains(per_text), len(label)
    text_of = np.repeat(np.arange(n), per_text)
    first = np.cumsum(per_text) - per_text
    follows = np.ones(len(z), bool)
    follows[first] = False
    after = np.flatnonzero(follows)

    def learn(y: np.ndarray, start: np.ndarray) -> np.ndarray:
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[after - 1], y[after]), 1)

        def gradient(p: np.ndarray) -> np.ndarray:
            good, moved = chains.marginals(z @ p[:FEATURES] + p[FEATURES], p[FEATURES + 1:].reshape(2, 2))
            miss = good - y
            return np.concatenate((z.T @ miss + p[:FEATURES], [miss.sum()], (moved - seen).ravel() + p[FEATURES + 1:])) / len(z)
        return _climb(gradient, start, steps)

    y = label[text_of].astype(int)
    p = learn(y, np.zeros(FEATURES + 5))
    # Bad documents often start or end with good lines: relabel those, but leave
    # each bad document its worst line.
    single = z @ p[:FEATURES] + p[FEATURES]
    worst = np.minimum.reduceat(single, first)[text_of]
    y = np.where((label[text_of] == 0) & (single > 0) & (single > worst), 1, y)
    p = learn(y, p)
    moves = p[FEATURES + 1:].reshape(2, 2)
    quality = _weighted(chains.marginals(z @ p[:FEATURES] + p[FEATURES], moves)[0], length, per_text)

    def slope(c: np.ndarray) -> np.ndarray:
        miss = _sigmoid(c[0] * (quality - 0.5) + c[1]) - label
        return np.array([(miss * (quality - 0.5)).sum() + 1e-3 * c[0], miss.sum()]) / n
    calibration = _climb(slope, np.array([8.0, 0.0]), 600)
    return Field(mean, scale, p[:FEATURES], p[FEATURES], moves, *calibration.tolist())


def score_lines(model: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score per text, P(good) per line, lines per text)."""
    x, length, per_text = line_features(data, offsets)
    score = ((x - model.mean) / model.scale) @ model.weights + model.bias
    good, _ = Chains(per_text).marginals(score, model.moves)
    return _sigmoid(model.slope * (_weighted(good, length, per_text) - 0.5) + model.shift), good, per_text


def _features_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        for at, to in parts(batch.column(0)):
            x, length, per_text = line_features(data, offsets[at:to + 1])
            cuts = np.concatenate(([0], np.cumsum(per_text)))
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(cuts, cuts[1:])]
            sizes = [length[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(sizes, pa.binary()), batch.column(1).slice(at, to - at)], ["x", "length", "label"])


def sampled(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that may be learned from, chosen by hash of their id.

    Contradicting labels of one id count as 0. The chosen ids are few by ``rows``,
    which makes them safe to broadcast.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_doc"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & ~held_out(F.col("_doc")))
        .groupBy("_doc").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("_doc"), "_doc").limit(rows)
    )
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return given.join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc")).select("doc_id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE) -> Field:
    """Fit on at most ``rows`` labelled documents (by hash of their id; none of the held-out fifth).

    Features, not texts, of those rows come to the driver.
    """
    sample = sampled(docs, labels, "quality", rows, doc_id, text).orderBy("doc_id", F.xxhash64("text")).select("text", "label")
    found = in_small_batches(sample).mapInArrow(_features_of_rows, "x binary, length binary, label int").limit(rows).collect()
    if not found:
        return fit(np.empty((0, FEATURES)), np.empty(0), np.empty(0, int), np.empty(0, int))
    x = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in found]
    return fit(np.concatenate(x).astype(float), np.concatenate([np.frombuffer(r.length) for r in found]),
               np.array([len(v) for v in x]), np.array([r.label for r in found]))


def _score_rows(model: Field, lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            data, offsets = buffers(column)
            for at, to in parts(column):
                scores, good, per_text = score_lines(model, data, offsets[at:to + 1])
                out = [batch.column(0).slice(at, to - at), pa.array(scores)]
                if lines:
                    out.append(pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(per_text))).astype(np.int32), pa.array(good)))
                yield pa.RecordBatch.from_arrays(out, ["row", "score", "good_lines"][:len(out)])
    return run


def score(docs: DataFrame, model: Field, text: str = "text", lines: bool = False) -> DataFrame:
    """``row`` (the input row as a struct) with ``score`` in 0..1, and with ``lines`` also each line's P(good).

    Whole texts are scored; a null or empty text is one empty line. Nothing but
    the text enters a score. No shuffle.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double" + (", good_lines array<double>" if lines else "")
    return in_small_batches(rows).mapInArrow(_score_rows(model, lines), schema)
