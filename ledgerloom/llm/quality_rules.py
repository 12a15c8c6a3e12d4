"""Quality rules: counts of a text, and a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, remainder
from ledgerloom.llm.features import Linear, descend, matrix, sigmoid, texts_of
from ledgerloom.llm.samples import drawn, labelled

SYMBOL = re.compile(r"[#*$%&|<>]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACES = " \t\n\x0b\x0c\r"
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Settings:
    """Learning reads at most ``rows`` whole labelled texts; every fifth calibrates."""

    rows: int = 4000
    steps: int = 100
    least_words: int = 50
    most_repeated_percent: int = 50
    least_probability: float = 0.5


@dataclass
class Calibrated:
    """Logistic regression with its log-odds put through a second one learned on other rows."""

    model: Linear
    slope: float
    shift: float

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return np.round(sigmoid(self.slope * self.model(texts) + self.shift), 9)


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of a whole text; words are split at ASCII white space alone."""
    if not text:
        return 0, 0, 0, 0, 0
    ws = [w for w in _SPLIT.split(text) if w]
    windows = list(zip(ws, ws[1:], ws[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        upto = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return len(ws), sum(map(len, ws)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated


def fit(texts: list[str], labels: np.ndarray, steps: int = 100) -> Calibrated:
    """Logistic regression on four rows of five, Platt scaling on the fifth."""
    fifth = np.arange(len(texts)) % 5 == 0
    if len(set(labels[fifth])) < 2 or len(set(labels[~fifth])) < 2:
        fifth = np.zeros(len(texts), dtype=bool)
    y = labels[~fifth].astype(float)
    model = descend(matrix([t for t, f in zip(texts, fifth) if not f]), lambda z: (sigmoid(z) - y) / len(y), steps)
    if not fifth.any():
        return Calibrated(model, 1.0, 0.0)
    z = model([t for t, f in zip(texts, fifth) if f])
    # Platt's targets keep the slope finite where the two classes are apart
    good = labels[fifth] == 1
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(slope * z + shift)
        w = np.maximum(p * (1 - p), 1e-9)
        design = np.stack([z, np.ones_like(z)], axis=1)
        hessian = design.T @ (design * w[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (p - target))
        step *= min(1.0, 1.0 / max(1e-12, np.abs(step).max()))
        slope, shift = max(1e-3, slope - step[0]), shift - step[1]
    return Calibrated(model, float(slope), float(shift))


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id") -> Calibrated | None:
    """Model from labelled rows whose crc32 remainder is not 0; None unless both labels occur."""
    rows = docs.select(key, "text").filter((remainder(key) != 0) & F.col("text").isNotNull())
    sample = drawn(labelled(rows, labels, "quality", key), settings.rows, key, "label")
    y = np.array([label for label, _ in sample])
    return fit([t for _, t in sample], y, settings.steps) if len(set(y.tolist())) > 1 else None


def judge(docs: DataFrame, model: Calibrated | None, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """(key, counts, base_failed, probability, kept) of every whole text.

    A text fails the base with too few words or too many of them in repeated windows of three; it is kept if it
    does not and its probability of being good reaches the threshold. NULL text counts as empty. Without a
    model the probability is NULL and the base alone decides. Repeated rows come out repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            found = np.array([counts(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
            n_words, repeated = found[:, 0], found[:, 4]
            failed = (n_words < settings.least_words) | (100 * repeated > settings.most_repeated_percent * n_words)
            p = model(texts) if model is not None else None
            kept = ~failed if p is None else ~failed & (p >= settings.least_probability)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[:, k]) for k in range(len(COUNTS))], pa.array(failed),
                 pa.array(p) if p is not None else pa.nulls(len(texts), pa.float64()), pa.array(kept)],
                names=[key, *COUNTS, "base_failed", "probability", "kept"],
            )

    schema = ", ".join([
        f"`{key}` {key_type(docs, key)}", *[f"{c} bigint" for c in COUNTS],
        "base_failed boolean, probability double, kept boolean",
    ])
    return docs.select(key, "text").mapInArrow(run, schema)
