"""Reading and writing Parquet tables."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet scan, with a declared DDL schema where one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_partitions(df: DataFrame, path: str, column: str) -> int:
    """Replace exactly the partitions present in ``df``, leaving the others; returns rows written."""
    written = Observation()
    # rebalance gives evenly sized files and splits a partition value that holds most rows
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    return written.get["rows"]


def _empty(df: DataFrame, path: str, column: str, value: str) -> None:
    df.drop(column).limit(0).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def replace_from(df: DataFrame, path: str, column: str, dt: str | dt_.date) -> int:
    """Leave exactly the rows of ``df`` in the partitions from day ``dt`` on; returns rows written.

    Partitions of ``df`` are replaced, older ones from ``dt`` on that it does not name are emptied afterwards.
    Where it fails between the two, those keep their old rows until it is run again with the same rows, which changes
    nothing else. Only the days present are listed on the driver.
    """
    spark, start = df.sparkSession, F.lit(str(dt)).cast("date")

    def days() -> set[str]:
        found = spark.read.parquet(path).select(F.col(column).cast("date").alias("day")).filter(F.col("day") >= start)
        return {str(r.day) for r in found.distinct().collect()}

    new = df.filter(F.col(column) >= start)
    named = {str(r.day) for r in new.select(F.col(column).cast("date").alias("day")).distinct().collect()}
    written = write_partitions(new, path, column)
    for day in sorted(days() - named):
        _empty(df, path, column, day)
    return written


def write_snapshot(df: DataFrame, path: str, as_of: str | dt_.date) -> None:
    """Replace one day's snapshot; a second run of the same day changes nothing.

    The old partition stays until the new one is committed. A day without rows empties it.
    """
    column = "snap_dt_part"
    dated = df.withColumn(column, F.lit(str(as_of)).cast("date"))
    if write_partitions(dated, path, column) == 0:
        _empty(dated, path, column, str(as_of))


def _days_of(df: DataFrame, column: str) -> set[str]:
    return {r.day for r in df.select(F.col(column).cast("string").alias("day")).distinct().collect()}


def _rewrite(spark: SparkSession, path: str, column: str, days: set[str], change) -> list[str]:
    """Replace the rows of the named partitions by ``change`` of them; no other partition is read or written.

    The new rows are written aside and committed when all are, so the partitions can be read meanwhile. Those that are
    left without rows are emptied after that; where it fails in between they keep their old rows until it runs again.
    """
    if days:
        stored = spark.read.parquet(path)
        kind = stored.schema[column].dataType.simpleString()
        old = stored.filter(F.col(column).isin([F.lit(d).cast(kind) for d in sorted(days)]))
        new = change(old).select(*stored.columns)
        left = _days_of(new, column)
        if left:
            write_partitions(new, path, column)
        for day in sorted(days - left):
            _empty(old, path, column, day)
    return sorted(days)


def _holding(spark: SparkSession, path: str, column: str, key: str, ids: DataFrame) -> DataFrame:
    """The partition values of stored rows whose key is among ``ids``: reads those two columns alone."""
    return spark.read.parquet(path).select(key, column).join(ids.select(key), key, "left_semi").select(column)


def upsert_stored(batch: DataFrame, path: str, column: str, key: str = "id") -> list[str]:
    """Rows of ``batch`` replace the stored rows of the same key; returns the partition values rewritten.

    A key may move to another partition: the partitions that hold the batch's keys now and those its rows go to are
    found first, and only they are read and written. Keys of the batch are unique and not NULL. Running it again with
    the same batch changes nothing. ``batch`` is read several times, so it should be a stored table, not a sample or a
    stream.
    """
    spark = batch.sparkSession
    days = _days_of(_holding(spark, path, column, key, batch).unionByName(batch.select(column)), column)
    ids = batch.select(key)
    return _rewrite(spark, path, column, days, lambda old: old.join(ids, key, "left_anti").unionByName(batch.select(*old.columns)))


def delete_stored(ids: DataFrame, path: str, column: str, key: str = "id") -> list[str]:
    """Stored rows whose key is among ``ids`` go; returns the partition values rewritten, the only ones touched."""
    spark = ids.sparkSession
    days = _days_of(_holding(spark, path, column, key, ids), column)
    return _rewrite(spark, path, column, days, lambda old: old.join(ids.select(key), key, "left_anti"))


def update_stored(spark: SparkSession, path: str, column: str, cond: Column, values: dict[str, Column]) -> list[str]:
    """Sets columns of the stored rows where ``cond`` holds; returns the partition values rewritten.

    Partitions without such a row are not written. The partition column itself cannot be set.
    """
    if column in values:
        raise ValueError("the partition column cannot be set; upsert the rows instead")
    days = _days_of(spark.read.parquet(path).filter(cond).select(column), column)

    def change(old: DataFrame) -> DataFrame:
        kinds = {c: old.schema[c].dataType for c in values}
        return old.withColumns({c: F.when(cond, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in values.items()})

    return _rewrite(spark, path, column, days, change)
