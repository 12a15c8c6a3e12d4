"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    alignment, caps, hard_negatives, hpylm, langid, mixing, multi_index, packing, quality_pu, quality_rules, simhash,
    substring, toxicity,
)
from ledgerloom.llm.common import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.log_likelihood(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=mixing.KEEP)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.learn(langid.learning_rows(docs)))
    return found.withColumn("held_out", remainder() == 0)


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).withColumn("n_removed", F.size("removed"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_pu.score(docs, quality_pu.learn(docs, _table(spark, sf_dir, "labels")))
    return found.withColumn("held_out", remainder() == 0)


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, quality_rules.learn(docs, _table(spark, sf_dir, "labels")))


def op11_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return multi_index.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(_table(spark, sf_dir, "documents")).documents(digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_pitman_yor, op2_simhash, op3_mixing, op4_packing, op5_toxicity, op6_language, op7_substring, op8_embeddings,
        op9_quality, op10_rules, op11_hamming, op12_negatives, op13_alignment,
    )}


def oracles() -> dict[str, str]:
    return {}
