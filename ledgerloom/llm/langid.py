"""Language identification by compression with per-language zstandard dictionaries."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, remainder, spread

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
NOT_LETTERS = (string.punctuation + string.digits).encode()


@dataclass(frozen=True)
class Settings:
    """About ``docs_per_lang`` whole texts are the learning sample of a language, ``dict_bytes`` its dictionary; the
    ``max_langs`` languages with most rows are learned, which bounds what is sent to the tasks."""

    docs_per_lang: int = 1500
    dict_bytes: int = 60_000
    level: int = 6
    block: int = 4096
    margin: float = 0.002
    max_langs: int = 1000


def normal(text: str) -> bytes:
    """Lower-cased words without ASCII digits and punctuation, one space between."""
    return b" ".join(text.lower().encode().translate(None, NOT_LETTERS).split())


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of each batch."""
    for batch in batches:
        seen: dict[str, Counter[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            seen.setdefault(lang, Counter()).update(normal(text.as_py()).split())
        rows = [(lang, word, n) for lang, words in seen.items() for word, n in words.items()]
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.string(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "word", "n"])


def learn(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id") -> dict[str, bytes]:
    """Raw-content dictionary of each language: its most frequent words in the sample, the commonest last.

    Learns from the rows with text and language that ``docs`` holds; of very many languages from those with most rows
    (the alphabetically first among equal ones). The sample is drawn by a hash of key and text, so it is the same
    however the rows are dealt. Words are counted where the texts are; the dictionaries alone reach the driver.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.max_langs).collect()
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, min(1.0, settings.docs_per_lang / r["count"]))])
    sample = usable.filter((spread(key, "text") % 1_000_003) / 1_000_003.0 < share[F.col("lang")])
    words = (
        sample.select("lang", "text").mapInArrow(_counted_words, "lang string, word binary, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    commonest = Window.partitionBy("lang").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, 0)
    fitting = words.withColumn("size", F.sum(F.octet_length("word") + 1).over(commonest)).filter(F.col("size") <= settings.dict_bytes)
    chosen: dict[str, list[tuple[int, bytes]]] = {r.lang: [] for r in counts}
    for r in fitting.toLocalIterator():
        chosen[r.lang].append((-r.size, bytes(r.word)))
    return {lang: b" ".join(word for _, word in sorted(found)) + b" " for lang, found in sorted(chosen.items()) if found}


class Classifier:
    """Compressed size of a text with each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.langs, self.settings, self.compressors = list(dictionaries), settings, []
        for content in dictionaries.values():
            table = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            table.precompute_compress(level=settings.level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=settings.level, dict_data=table, write_content_size=False, write_checksum=False,
                write_dict_id=False,
            ))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is too narrow. The whole text counts, block by block, so that
        a long text is compared by its dictionary throughout and not by its own past."""
        if not text or not self.langs or not LETTER.search(text):
            return UNDETERMINED, 0.0, True
        data, block = normal(text), self.settings.block
        blocks = [data[i : i + block] for i in range(0, max(1, len(data)), block)]
        sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], dtype=float)
        best = int(sizes.argmin())
        score = 1.0 / float(np.exp2(np.clip((sizes[best] - sizes) / 4, -60, 0)).sum())
        rest = np.delete(sizes, best)
        narrow = bool(len(rest)) and (rest.min() - sizes[best]) / sizes[best] < self.settings.margin
        return self.langs[best], score, narrow


def predict(
    docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings(), key: str = "doc_id"
) -> DataFrame:
    """(key, lang_pred, score, rejected) from the whole text alone.

    ``und``, score 0 and rejected where the text is NULL or has no letter, or where nothing was learned.
    Otherwise the language of the smallest encoding, the alphabetically first among equal ones; rejected if
    the next one is larger by less than ``margin`` of it. Repeated rows come out repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries, settings)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())],
                names=[key, "lang_pred", "score", "rejected"],
            )

    schema = f"`{key}` {key_type(docs, key)}, lang_pred string, score double, rejected boolean"
    return docs.select(key, "text").mapInArrow(run, schema)


def accepted(
    docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings(), text: str = "text"
) -> DataFrame:
    """Rows of ``docs``, with all their columns, that ``predict`` does not reject.

    Each row is judged by its text where it is read, so nothing is shuffled and rows need no key.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries, settings)
        for batch in batches:
            yield batch.filter(pa.array([not classify(t.as_py())[2] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learning_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: those whose crc32 remainder is not 0."""
    return docs.filter(remainder(key) != 0)
