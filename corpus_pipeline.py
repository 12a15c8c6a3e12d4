"""Documents to packed training sequences: language, near-duplicates, repeated passages, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import langid, mixing, packing, simhash, substring
from ledgerloom.llm.common import saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is undetermined or too close to another; ``lang`` stays as given.

    NULL, blank and letterless texts have no language and go; without one labelled text nothing can be told and all go.
    """
    rows = docs.select(*COLUMNS)
    return langid.accepted(rows, langid.learn(langid.learning_rows(rows)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that of the smallest doc_id (NULL last, then by the text's hash), once.

    A document is a doc_id and a text, so rows without a doc_id or with a repeated one stay unless they are copies.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    rows = docs.select(*COLUMNS, row.alias("_row"))
    chosen = simhash.near_duplicates(rows, key="_row").filter("_row = component_id").select("_row")
    return rows.join(chosen, "_row", "left_semi").dropDuplicates(["_row"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines and passages, drops documents of which nothing is left, counts n_chars anew.

    Documents that nothing is cut from stay as they are, NULL and empty ones too; an empty table gives an empty one.
    """
    clean = substring.remove_repeats(docs.select(*COLUMNS))
    left = clean.filter((F.size("removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    count = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", count.cast("bigint")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of about nine tenths of the tokens, sampled towards tempered source, language and topic shares.

    NULL labels are a class of their own, a document without a word stays, an empty table gives an empty one.
    """
    rows = docs.select("doc_id", "text", "lang", "source", F.struct(*COLUMNS).alias("_row"))
    return mixing.mix(rows, carried=("_row",), keep=mixing.KEEP).filter("sampled").select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and place; NULL and empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("packing", packed),
]

# Compression, fingerprints and tokenizing cannot be written in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
    return docs
