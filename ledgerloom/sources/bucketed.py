"""Tables bucketed by loan, so that joins and sums by loan need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, partition: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in ``buckets`` buckets of ``key`` under ``path``, and gives the table.

    Tables written with one number of buckets and one type of key meet without a shuffle: loans by ``id``, payments and
    balances by ``loan_id``. Rows are dealt by the key first, so a bucket is one file in each partition. With a
    ``partition`` column, days can still be pruned; a table of few rows a day is better left without. The number of
    buckets is the number of tasks that later read the table: choose it for the table's size, some hundred megabytes
    each. The table's description is kept in the session's catalog.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if partition:
        writer = writer.partitionBy(partition)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, key: str, buckets: int, partition: str | None = None
) -> DataFrame:
    """A table that ``write_bucketed`` wrote, described again in a session that does not know it."""
    columns = spark.read.parquet(path).schema
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    by = f"PARTITIONED BY (`{partition}`) " if partition else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet {by}"
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def same_buckets(spark: SparkSession, **tables: str) -> dict[str, DataFrame]:
    """Opened tables by name, checked to share one number of buckets; joins of others would shuffle silently."""
    counts = {}
    for name, table in tables.items():
        found = spark.sql(f"DESCRIBE EXTENDED {table}").filter(F.col("col_name") == "Num Buckets").first()
        counts[name] = found.data_type if found else "none"
    if len(set(counts.values())) != 1 or "none" in counts.values():
        raise ValueError(f"tables must have one number of buckets: {counts}")
    return {name: spark.table(table) for name, table in tables.items()}
