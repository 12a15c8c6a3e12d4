"""Hashed n-gram and shape features of texts, computed for a batch of texts at once, and a linear model on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BITS = 16
SIZE = 1 << BITS
# A model has a weight for each hashed character 4-gram, word and pair of words, and a last one that stays zero.
WEIGHTS = 3 * SIZE + 1
NOTHING = 3 * SIZE
DENSE = 8
# Texts go through numpy in portions of about this many bytes; a longer text is cut between words.
PORTION = 1 << 20
SCALE = 5.0
# Dense features count this much more, so that few steps of learning suffice for them.
DENSE_SCALE = 10.0

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b"#*$%&|<>")] = True
_PAD = b"   "
_BY_PLACE = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass
class Grams:
    """Feature numbers of several texts end to end: ``index[k][at[k][i]:at[k][i + 1]]`` are text i's of kind k."""

    index: list[np.ndarray]
    at: list[np.ndarray]
    counts: np.ndarray


def _portions(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of texts, each with the number of its text, in portions of bounded size."""
    of, parts, size = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode()
        while True:
            cut = len(data)
            if cut > PORTION:
                cut = max(data.rfind(b" ", 0, PORTION), data.rfind(b"\n", 0, PORTION)) + 1 or PORTION
            of.append(i)
            parts.append(data[:cut])
            size += cut
            data = data[cut:]
            if size >= PORTION:
                yield of, parts
                of, parts, size = [], [], 0
            if not data:
                break
    if parts:
        yield of, parts


def grams(parts: list[bytes]) -> Grams:
    """Features of each part. Counts: bytes, words, marks, capitals, digits, exclamation marks, repeated words."""
    raw = np.frombuffer(b"".join(p + _PAD for p in parts), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(p) + len(_PAD) for p in parts])))
    n = len(raw)
    body = np.ones(n, dtype=bool)
    for k in range(1, len(_PAD) + 1):
        body[begin[1:] - k] = False
    # characters: four bytes read as one number
    wide = np.zeros(n, dtype=np.uint32)
    for k in range(4):
        wide[: n - k] |= raw[k:].astype(np.uint32) << np.uint32(8 * k)
    chars = ((wide * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    chars[~body] = NOTHING
    # words: sum of bytes times a random number for their place, A-Z lower-cased
    upper = (raw >= 65) & (raw <= 90)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    low = (raw + (upper.view(np.uint8) << np.uint8(5))).astype(np.uint64)
    if len(starts):
        run = np.diff(np.concatenate((starts, [n])))
        place = np.zeros(n, dtype=np.int64)
        place[starts[0] :] = np.arange(starts[0], n) - np.repeat(starts, run)
        value = np.where(space, np.uint64(0), (low + np.uint64(1)) * _BY_PLACE[place & 63])
        words = np.add.reduceat(value, starts)
    else:
        words = np.zeros(0, dtype=np.uint64)
    first_word = np.searchsorted(starts, begin)
    shift = np.uint64(64 - BITS)
    mixer = np.uint64(0x9E3779B97F4A7C15)
    single = ((words * mixer) >> shift).astype(np.int64) + SIZE
    following = np.concatenate((words[1:], np.zeros(min(1, len(words)), dtype=np.uint64)))
    pair = (((words * np.uint64(31) + following) * mixer) >> shift).astype(np.int64) + 2 * SIZE
    same = words == following
    last = first_word[1:][first_word[1:] > first_word[:-1]] - 1
    pair[last] = NOTHING
    same[last] = False

    def total(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[at])

    counts = np.stack([
        np.diff(begin) - len(_PAD), np.diff(first_word), total(_MARKS[raw], begin), total(upper, begin),
        total((raw >= 48) & (raw <= 57), begin), total(raw == 33, begin), total(same, first_word),
    ], axis=1).astype(float)
    return Grams([chars, single, pair], [begin, first_word, first_word], counts)


def shape(counts: np.ndarray) -> np.ndarray:
    """Dense features from the counts of whole texts."""
    size, n_words = np.maximum(counts[:, 0], 1), np.maximum(counts[:, 1], 1)
    ratios = [np.sqrt(counts[:, k] / size) for k in (2, 3, 4, 5)] + [np.sqrt(counts[:, 6] / n_words)]
    return DENSE_SCALE * np.stack(
        [*ratios, np.log1p(counts[:, 1]) / 10, np.minimum(size / n_words / 10, 3), counts[:, 1] < 20], axis=1
    )


@dataclass
class Linear:
    """Log-odds: mean weight of each kind of feature, plus the dense part."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        sums, counts = np.zeros((len(texts), 3)), np.zeros((len(texts), 7))
        for of, parts in _portions(texts):
            g = grams(parts)
            for k in range(3):
                running = np.concatenate(([0.0], np.cumsum(self.weights[g.index[k]])))
                np.add.at(sums[:, k], of, np.diff(running[g.at[k]]))
            np.add.at(counts, of, g.counts)
        per = np.maximum(counts[:, [0, 1, 1]], 1)
        return SCALE * (sums / per).sum(axis=1) + shape(counts) @ self.dense + self.bias


@dataclass
class Matrix:
    """Sparse rows for learning."""

    row: np.ndarray
    index: np.ndarray
    value: np.ndarray
    dense: np.ndarray

    def score(self, model: Linear) -> np.ndarray:
        flat = np.bincount(self.row, self.value * model.weights[self.index], minlength=len(self.dense))
        return flat + self.dense @ model.dense + model.bias

    def gradient(self, by_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        flat = np.bincount(self.index, self.value * by_row[self.row], minlength=WEIGHTS)
        flat[NOTHING] = 0
        return flat, self.dense.T @ by_row, float(by_row.sum())


def matrix(texts: list[str | None], least_docs: int = 8) -> Matrix:
    """Rows of ``texts``, without features that occur in fewer than ``least_docs`` of them."""
    found, n, counts = [], [], np.zeros((len(texts), 7))
    for of, parts in _portions(texts):
        g = grams(parts)
        for k in range(3):
            keys = np.repeat(np.array(of), np.diff(g.at[k])) * WEIGHTS + g.index[k]
            for values, into in zip(np.unique(keys, return_counts=True), (found, n)):
                into.append(values)
        np.add.at(counts, of, g.counts)
    keys = np.concatenate([np.zeros(0, dtype=np.int64), *found])
    row, index = (keys // WEIGHTS).astype(np.int32), (keys % WEIGHTS).astype(np.int32)
    often = (np.bincount(index, minlength=WEIGHTS) >= least_docs)[index] & (index != NOTHING)
    row, index, n = row[often], index[often], np.concatenate([np.zeros(0, dtype=np.int64), *n])[often]
    per = np.maximum(counts[:, [0, 1, 1]], 1)[row, np.minimum(index // SIZE, 2)]
    return Matrix(row, index, (SCALE * n / per).astype(np.float32), shape(counts))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def descend(
    rows: Matrix, slope: Callable[[np.ndarray], np.ndarray], steps: int = 100, rate: float = 0.1, decay: float = 1e-4
) -> Linear:
    """Adam from zero. ``slope`` gives the derivative of the risk by each row's log-odds."""
    model = Linear(np.zeros(WEIGHTS), np.zeros(DENSE), 0.0)
    moments = None
    for t in range(1, steps + 1):
        flat, dense, bias = rows.gradient(slope(rows.score(model)))
        g = np.concatenate((flat + decay * model.weights, dense + decay * model.dense, [bias]))
        if moments is None:
            moments = [np.zeros_like(g), np.zeros_like(g)]
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        model = Linear(model.weights - move[:WEIGHTS], model.dense - move[WEIGHTS:-1], model.bias - float(move[-1]))
    return Linear(model.weights.astype(np.float32), model.dense, model.bias)


def texts_of(column: pa.Array) -> list[str | None]:
    return column.to_pylist()
