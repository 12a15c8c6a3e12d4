"""Learning samples: bounded by rows, of whole texts, and the same however a table is dealt."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm import langid
from ledgerloom.llm.samples import drawn

DOCS = "doc_id BIGINT, text STRING, lang STRING"


def test_rows_of_one_key_are_drawn_by_their_texts_and_bounded(spark):
    rows = [(7, f"text {i}", "a") for i in range(500)] + [(i, f"other {i}", "b") for i in range(500)]
    docs = spark.createDataFrame(rows, DOCS)
    got = drawn(docs, 100, "doc_id", "lang")
    assert len(got) == 100 == len(set(got)) and {len(r) for r in got} == {2}
    assert 20 < sum(lang == "a" for lang, _ in got) < 80  # neither all of the repeated key nor none
    assert drawn(docs.repartition(7).orderBy(F.rand(1)), 100, "doc_id", "lang") == got
    assert drawn(docs.limit(0), 5, "doc_id") == [] and len(drawn(docs.limit(3), 5, "doc_id")) == 3


def test_texts_are_whole(spark):
    text = "word " * 40_000
    assert drawn(spark.createDataFrame([(1, text, "a")], DOCS), 5, "doc_id") == [(text,)]


def test_dictionaries_equal_counting_on_the_driver(spark):
    """With every row in the sample: the most frequent words of whole texts, the commonest last, up to the size."""
    rng = random.Random(3)
    words = {lang: [f"{lang}{i}" for i in range(300)] for lang in "pqr"}
    rows = [(i, " ".join(rng.choices(words["pqr"[i % 3]], k=2000)), "pqr"[i % 3]) for i in range(12)]
    settings = langid.Settings(dict_bytes=500)
    got = langid.learn(spark.createDataFrame(rows, DOCS), settings)
    for lang in "pqr":
        seen = Counter(w for _, text, x in rows if x == lang for w in langid.normal(text).split())
        chosen, size = [], 0
        for word, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            size += len(word) + 1
            if size > 500:
                break
            chosen.append(word)
        assert got[lang] == b" ".join(reversed(chosen)) + b" "


def test_words_far_into_a_text_are_learned(spark):
    rows = [(1, "same " * 3000 + "alpha beta gamma", "a"), (2, "same " * 3000 + "delta epsilon zeta", "b")]
    got = langid.learn(spark.createDataFrame(rows, DOCS))
    assert b"gamma" in got["a"] and b"zeta" in got["b"]


def test_of_very_many_languages_those_with_most_rows_are_learned(spark):
    rows = [(i, f"words of {i % 40} here", f"l{i % 40:02}") for i in range(200)] + [(900 + i, "more words", "l07") for i in range(5)]
    got = langid.learn(spark.createDataFrame(rows, DOCS), langid.Settings(max_langs=3))
    assert set(got) == {"l07", "l00", "l01"}
    assert langid.learn(spark.createDataFrame([(1, "12 ..", "a"), (2, "text", None), (3, None, "a")], DOCS)) == {}
