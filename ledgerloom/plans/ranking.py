"""Row numbers that do not put a hot group in one task."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[str], cells: list[Column], name: str) -> DataFrame:
    """``row_number`` within ``keys`` by ``order`` as a bigint column ``name``, the same way for groups of any size.

    Every group is cut into ``cells``: expressions that never decrease along ``order`` (NULLs first). A row's
    number is its place inside its cell plus the rows of the earlier cells, so a task sorts one cell and not one
    group. Cells are counted map-side; the input is read twice, whatever its groups. Keys and cells may be
    NULL: NULL keys are one group. ``order`` must be unique within a group, and ``df`` must give the same rows
    each time it is read.
    """
    names = [f"_cell{i}" for i in range(len(cells))]
    by = [*keys, *names]
    celled = df.withColumns(dict(zip(names, cells)))
    placed = celled.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    earlier = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*[F.col(c).alias(f"_of_{c}") for c in by], "_before")
    )
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])
    return (
        placed.join(offsets, same)
        .withColumn(name, F.col("_place").cast("bigint") + F.col("_before"))
        .select(*[c for c in df.columns if c != name], name)
    )
