"""Bounded learning samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import spread


def drawn(rows: DataFrame, n: int, key: str, *columns: str) -> list[tuple]:
    """At most ``n`` rows (``columns``, text) drawn by a hash of key and text, in its order, texts whole.

    Only these reach the driver, however many rows share a key: every task sends its first ``n`` at most. The same
    rows are drawn however the table is dealt.
    """
    total = rows.count()
    if not total:
        return []
    at = spread(key, "text")
    few = rows.filter((at % 1_000_003) / 1_000_003.0 < min(1.0, 1.2 * n / total + 1e-9))
    chosen = few.select(at.alias("_at"), *columns, "text").orderBy("_at", "text", *columns).limit(n)
    return [tuple(r)[1:] for r in chosen.collect()]


def labelled(docs: DataFrame, labels: DataFrame, column: str, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with their label; a document whose label rows disagree or are NULL has none."""
    one = labels.groupBy(key).agg(F.min(column).alias("label"), F.max(column).alias("_most"))
    return docs.select(key, "text").join(one.filter(F.col("label") == F.col("_most")).drop("_most"), key)
