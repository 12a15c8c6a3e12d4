"""Quality classifier learned from trusted positives and unlabelled text by non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, remainder
from ledgerloom.llm.features import Linear, descend, matrix, sigmoid, texts_of
from ledgerloom.llm.samples import drawn, labelled


@dataclass(frozen=True)
class Settings:
    """Learning reads at most ``positives`` and ``unlabelled`` whole texts."""

    positives: int = 1500
    unlabelled: int = 2500
    steps: int = 120
    prior: float | None = None
    threshold: float = 0.3


def fit(positive: list[str], unlabelled: list[str], prior: float, steps: int = 100, decay: float = 1e-3) -> Linear:
    """Minimises prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)]) with the logistic loss l.

    Where the second term falls below zero, the step goes back up along it instead of descending.
    """
    rows = matrix(positive + unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    is_p = np.arange(n_p + n_u) < n_p

    def slope(z: np.ndarray) -> np.ndarray:
        up, down = sigmoid(z), -sigmoid(-z)  # derivatives of l(-z) and of l(z)
        softplus = np.logaddexp(0, z)
        negative = np.where(is_p, -prior * up / n_p, up / n_u)
        if softplus[~is_p].mean() - prior * softplus[is_p].mean() < 0:
            return -negative
        return negative + np.where(is_p, prior * down / n_p, 0)

    return descend(rows, slope, steps, decay=decay)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id") -> Linear | None:
    """Model from rows whose crc32 remainder is not 0; None where there are no positives.

    Trusted positives are rows labelled 1; unlabelled is the text of rows without a label or, where every row has
    one, the text of all rows, whose labels are then left aside. The class prior is
    the share of 1 among all labelled rows that may be learned from, unless given.
    """
    rows = docs.select(key, "text").filter((remainder(key) != 0) & F.col("text").isNotNull())
    known = labelled(rows, labels, "quality", key)
    counts = known.agg(F.avg(F.col("label").cast("double")).alias("share")).first()
    positive = [t for (t,) in drawn(known.filter("label = 1"), settings.positives, key)]
    others = rows.join(labels.select(key).distinct(), key, "left_anti")
    unlabelled = [t for (t,) in drawn(others, settings.unlabelled, key)]
    if not unlabelled:
        unlabelled = [t for (t,) in drawn(rows, settings.unlabelled, key)]
    if not positive or not unlabelled:
        return None
    prior = settings.prior if settings.prior is not None else counts.share
    return fit(positive, unlabelled, min(max(prior, 0.01), 0.99), settings.steps)


def score(docs: DataFrame, model: Linear | None, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) of every whole text.

    NULL text scores as empty; without a model every score is 0.5. Repeated rows come out repeated, and rows of
    one text score alike wherever they stand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            z = model(texts) if model is not None else np.zeros(len(texts))
            p = np.round(sigmoid(z), 9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= settings.threshold).astype(np.int32))],
                names=[key, "score", "predicted"],
            )

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {key_type(docs, key)}, score double, predicted int")
