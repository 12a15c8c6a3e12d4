"""The pipeline stage by stage, over the smallest test tables and over rows that are missing or repeated."""

import os

import pytest

import corpus_pipeline
from ledgerloom.llm import simhash
from ledgerloom.llm.common import saved
from tests.llm.test_operators import DOCS, MESSY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")
def test_stages_keep_their_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(saved(stage(spark, kept[-1], SF)))
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[-1] == ids[-2]
    assert all(t.columns == list(corpus_pipeline.COLUMNS) for t in kept[1:-1])
    assert len(ids[1]) > 0.97 * len(ids[0])
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept[1]).collect()}
    assert ids[2] == set(groups.values()) and kept[2].count() == len(ids[2])
    run = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(run) == sorted(kept[-1].select("doc_id", "piece", "ids_crc32").collect())


def test_messy_and_empty_tables(spark):
    for rows in (MESSY, []):
        docs = spark.createDataFrame(rows, DOCS)
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF))
            assert (docs.count() > 0) == bool(rows), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")
def test_rows_without_their_own_id_stay_unless_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.near_duplicates(spark, saved(corpus_pipeline.language_id(spark, docs, SF)), SF)
    apart = sorted(kept.collect(), key=lambda r: r.doc_id)[:60]
    rows = [(None if i < 20 else 7 if i < 40 else r.doc_id, *r[1:]) for i, r in enumerate(apart)]
    again = spark.createDataFrame(rows + rows[10:30] + [(None, *rows[50][1:])], kept.schema)
    found = corpus_pipeline.near_duplicates(spark, again, SF).collect()
    assert sorted(map(str, found)) == sorted(str(r) for r in spark.createDataFrame(rows, kept.schema).collect())
    accepted = corpus_pipeline.language_id(spark, saved(docs.unionByName(again)), SF)
    assert accepted.filter("doc_id is null").count() >= 30
    mixed = corpus_pipeline.mixture(spark, again, SF).collect()
    assert mixed and {tuple(r) for r in mixed} <= {tuple(r) for r in again.collect()}
