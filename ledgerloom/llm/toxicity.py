"""Toxicity severity by cumulative-link ordinal regression on the words of a text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, remainder
from ledgerloom.llm.features import sigmoid, texts_of
from ledgerloom.llm.samples import drawn, labelled

TOKEN = re.compile(r"[^\W\d_]+")
GRADES = 4


@dataclass(frozen=True)
class Settings:
    """Learning reads at most ``rows`` whole labelled texts of each label, and keeps
    weights for at most ``vocabulary`` words, which is what is sent to the tasks. ``least_z`` is how many
    standard deviations, and ``least_times`` how many times, a word must be more frequent in toxic texts than in
    others to be a feature; ``least_docs`` and ``least_share`` are the fewest toxic texts it must stand in, so that
    the rare words of a few copies are none."""

    rows: int = 2500
    vocabulary: int = 5000
    least_docs: int = 3
    least_z: float = 4.0
    least_times: float = 10.0
    least_share: float = 0.01
    steps: int = 400
    decay: float = 1e-4
    threshold: float = 0.5


@dataclass
class Ordinal:
    """P(grade >= k) = sigmoid(f - cuts[k - 1]); one weight for a word serves all thresholds."""

    weights: dict[str, float]
    cuts: np.ndarray

    def latent(self, text: str | None) -> float:
        if not text:
            return 0.0
        present = self.weights.keys() & set(TOKEN.findall(text.lower()))
        return float(sum(self.weights[w] for w in sorted(present)))

    def above(self, latent: np.ndarray) -> np.ndarray:
        return sigmoid(latent[:, None] - self.cuts[None, :])


def unlike(texts: list[str]) -> list[int]:
    """Places of one text of each set of near-copies: texts whose smallest hash of four words in a row is equal."""
    first: dict[int, int] = {}
    for i, text in enumerate(texts):
        ws = TOKEN.findall(text.lower())
        first.setdefault(min((xxhash.xxh64_intdigest(" ".join(ws[k : k + 4])) for k in range(max(1, len(ws) - 3)))), i)
    return sorted(first.values())


def grades(texts: list[str], toxic: np.ndarray, settings: Settings = Settings()) -> np.ndarray:
    """0 where not toxic, else 1 to 3 by thirds of how many of the telling words a text holds.

    The labels are binary; the words that tell toxic texts from others stand for how severe they are.
    """
    sets = [set(TOKEN.findall(t.lower())) for t in texts]
    marked = set(features(sets, toxic, settings))
    held = np.array([len(ws & marked) for ws in sets])
    found = np.zeros(len(texts), dtype=int)
    if toxic.any():
        low, high = np.quantile(held[toxic == 1], [1 / 3, 2 / 3])
        found[toxic == 1] = 1 + (held[toxic == 1] > low) + (held[toxic == 1] > high)
    return found


def features(sets: list[set[str]], toxic: np.ndarray, settings: Settings = Settings()) -> list[str]:
    """Words significantly more frequent, by documents, in toxic texts than in others, the clearest first."""
    n1, n0 = int((toxic == 1).sum()), int((toxic == 0).sum())
    seen = [Counter(w for ws, t in zip(sets, toxic) if t == k for w in ws) for k in (0, 1)]
    found = []
    for w, c1 in seen[1].items():
        share = (c1 + seen[0][w]) / (n1 + n0)
        spread_ = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0)) or 1e-12
        z = (c1 / n1 - seen[0][w] / n0) / spread_
        times = (c1 + 0.5) / n1 / ((seen[0][w] + 0.5) / n0)
        if c1 >= max(settings.least_docs, settings.least_share * n1) and z >= settings.least_z and times >= settings.least_times:
            found.append((-z, w))
    return [w for _, w in sorted(found)[: settings.vocabulary]]


def fit(texts: list[str], grade: np.ndarray, settings: Settings = Settings()) -> Ordinal:
    """Maximises the ordinal likelihood with a small quadratic penalty, by Adam over all rows. The thresholds
    are a first one plus positive gaps, so they stay in order."""
    sets = [set(TOKEN.findall(t.lower())) for t in texts]
    number = {w: i for i, w in enumerate(features(sets, (grade > 0).astype(int), settings))}
    pairs = [(i, number[w]) for i, ws in enumerate(sets) for w in sorted(ws & number.keys())]
    row, col = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    n, k = len(texts), len(number)
    at = np.arange(n)
    x = np.concatenate((np.zeros(k), [2.0], np.zeros(GRADES - 2)))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, settings.steps + 1):
        cuts = np.cumsum(np.concatenate((x[k : k + 1], np.exp(x[k + 1 :]))))
        f = np.bincount(row, x[:k][col], minlength=n)
        edge = np.concatenate((np.ones((n, 1)), sigmoid(f[:, None] - cuts[None, :]), np.zeros((n, 1))), axis=1)
        slope = edge * (1 - edge)
        mass = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-9) * n
        above, below = slope[at, grade] / mass, slope[at, grade + 1] / mass
        by_cut = np.array([above[grade == c + 1].sum() - below[grade == c].sum() for c in range(GRADES - 1)])
        later = np.cumsum(by_cut[::-1])[::-1]
        g = np.concatenate((
            np.bincount(col, (below - above)[row], minlength=k) + settings.decay * x[:k],
            later[:1], later[1:] * np.exp(x[k + 1 :]),
        ))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    cuts = np.cumsum(np.concatenate((x[k : k + 1], np.exp(x[k + 1 :]))))
    return Ordinal({w: float(x[i]) for w, i in number.items()}, cuts)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id") -> Ordinal | None:
    """Model from labelled rows whose crc32 remainder is not 0; None unless both labels occur."""
    rows = docs.select(key, "text").filter((remainder(key) != 0) & F.col("text").isNotNull())
    known = labelled(rows, labels, "toxic", key)
    sample = [
        row for value in (0, 1)
        for row in drawn(known.filter(F.col("label") == value), settings.rows, key, "label")
    ]
    toxic = np.array([label for label, _ in sample], dtype=int)
    if len(set(toxic.tolist())) < 2:
        return None
    texts = [t for _, t in sample]
    kept = unlike(texts)
    texts, toxic = [texts[i] for i in kept], toxic[kept]
    return fit(texts, grades(texts, toxic, settings), settings) if len(set(toxic.tolist())) > 1 else None


def score(docs: DataFrame, model: Ordinal | None, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """(key, severity, grade, p_toxic, toxic) of every whole text.

    ``severity`` is the expected grade from 0 to 3, ``grade`` the most probable one, ``p_toxic`` the
    probability of a grade above 0. NULL and empty texts have no words and so the base rate. Without a model
    severity, grade and p_toxic are NULL and nothing is toxic. Repeated rows come out repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            if model is None:
                none = [pa.nulls(len(texts), k) for k in (pa.float64(), pa.int32(), pa.float64())]
                columns = [*none, pa.array([False] * len(texts), pa.bool_())]
            else:
                above = model.above(np.array([model.latent(t) for t in texts]))
                edge = np.concatenate((np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))), axis=1)
                likely = (edge[:, :-1] - edge[:, 1:]).argmax(axis=1)
                p = np.round(above[:, 0], 9)
                columns = [
                    pa.array(np.round(above.sum(axis=1), 9)), pa.array(likely.astype(np.int32)), pa.array(p),
                    pa.array(p >= settings.threshold),
                ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=[key, "severity", "grade", "p_toxic", "toxic"]
            )

    schema = f"`{key}` {key_type(docs, key)}, severity double, grade int, p_toxic double, toxic boolean"
    return docs.select(key, "text").mapInArrow(run, schema)
