"""Rows held by a key, in partitions that stay small."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Up to so many rows of a partition, the sorts and windows of a task stay near the least that they take.
PARTITION_ROWS = 500_000


def by_key(df: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """Rows by a hash of ``key`` in ``spark.sql.shuffle.partitions`` partitions, which are not merged.

    Where the number of ``rows`` is known, there are as many more partitions as keep each at PARTITION_ROWS, so that
    a task does not grow with the table. What is joined to them by the key is dealt into as many.

    AQE merges partitions up to a size in compressed bytes, and a task's sorts and hash tables are many times that. A
    number that is asked for is kept, so a task holds one part of that many. Joins, groups and windows by the key that
    follow need no further shuffle.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(rows / PARTITION_ROWS)), key)
