"""What the operators share: word rules, row keys, stable hashes and tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word as a regular expression, for use in SQL.
WORD = "[^\\x20\\x09-\\x0D]+"

_OWN: dict[str, str] = {}


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text with A-Z lower-cased. ``bytes`` lowers and splits by ASCII alone."""
    return text.encode().lower().split() if text else []


def remainder(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5: what splits rows into learning and held-out. NULL counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5, F.lit(0))


def spread(*columns: str) -> Column:
    """Non-negative hash by which rows are dealt to tasks."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(2**62 - 1))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one in local mode where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _OWN[context.applicationId]


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
