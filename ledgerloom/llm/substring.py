"""Repeated lines and sentence runs, removed by hashing them across the whole corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, key_type, saved

# A unit below this many words is too common to mean anything and is never compared.
LEAST_WORDS = 5
# Runs of sentences within a line are compared from this many words on, so that a passage set into different lines
# is found.
RUN_WORDS = 10
# A sentence above this many words is cut further, behind the word pairs whose hash is the smallest so far around.
LONG_WORDS, AROUND = 30, 3
SENTENCE_END = re.compile(r"[.!?]+\s+|[。！？｡।]+\s*")
# Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Chinese. Two characters count as a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{UNSPACED}]")
_WORD = re.compile(r"\S+")
_TOKEN = re.compile(f"[{UNSPACED}]|[^\\s{UNSPACED}]+")


def count_words(text: str) -> float:
    """Words, or half the characters where the script has no spaces."""
    if text.isascii() or not _UNSPACED.search(text):
        return len(text.split())
    return sum(0.5 if _UNSPACED.match(x) else 1 for x in _TOKEN.findall(text))


def hashed_cuts(text: str) -> list[int]:
    """Places in a text, each before a word, that depend on the few words around alone."""
    lower = text.lower() if len(text.lower()) == len(text) else text
    spaced = text.isascii() or not _UNSPACED.search(text)
    tokens = list((_WORD if spaced else _TOKEN).finditer(lower))
    words, size = [m.group() for m in tokens], len(tokens)
    digest = xxhash.xxh3_64_intdigest
    if spaced:
        marks = [1 << 64, *(digest(f"{a} {b}") for a, b in zip(words, words[1:]))]
        around = [AROUND] * size
    else:
        around = [2 * AROUND if _UNSPACED.match(w) else AROUND for w in words]
        marks = [1 << 64, *(digest(" ".join(words[max(0, i - a // 2 - 1) : i + a // 2])) for i, a in enumerate(around[1:], 1))]
    found, i = [], 1
    while i < size:
        a = around[i]
        # the first of the smallest within ``a`` words on both sides
        if a <= i <= size - a and marks[i] < min(marks[i - a : i]) and marks[i] == min(marks[i : i + a + 1]):
            found.append(tokens[i].start())
        i += 1
    return found


def units(text: str, run_words: int = RUN_WORDS, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised unit) of a text, in order of start and of end; units of a line may overlap.

    A line is cut behind every sentence end, long sentences at places picked by a hash of the words around, so
    cuts depend on the words near them alone. From each part on, the shortest run of parts of at least
    ``run_words`` words is a unit; a line of fewer words is one. Normalised: lower-cased, white space single.
    ``end`` takes in the white space up to the next part. Lines of fewer than ``least`` words are passed over.
    """
    at, spaced = 0, text.isascii() or not _UNSPACED.search(text)
    for line in text.split("\n"):
        stop, begin, parts, total = at + len(line), 0, [], 0
        for end in [*(m.end() for m in SENTENCE_END.finditer(line)), len(line)]:
            if end == begin:
                continue
            part = line[begin:end]
            words = part.lower().split()
            n = len(words) if spaced else count_words(part)
            if n > LONG_WORDS:
                inner = [begin, *(begin + x for x in hashed_cuts(part)), end]
                for c, d in zip(inner, inner[1:]):
                    words = line[c:d].lower().split()
                    m = len(words) if spaced else count_words(line[c:d])
                    parts.append((at + c, at + d, m, words))
                    total += m
            else:
                parts.append((at + begin, at + end, n, words))
                total += n
            begin = end
        beyond = min(stop + 1, len(text))
        if total < run_words:
            if parts and total >= least:
                yield at, beyond, " ".join([w for *_, ws in parts for w in ws])
        else:
            last, n, size = 0, 0, len(parts)
            for i, (a, _, own, words) in enumerate(parts):
                while last < size and n < run_words:
                    n += parts[last][2]
                    last += 1
                if n < run_words:
                    break
                if n >= least:
                    if last > i + 1:
                        words = text[a : parts[last - 1][1]].lower().split()
                    yield a, beyond if last == size else parts[last - 1][1], " ".join(words)
                n -= own
        at = stop + 1


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans, which are in order of start and of end and may overlap."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])  # nothing where spans overlap
        at = b
    kept.append(text[at:])
    return "".join(kept)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _unit_rows(key: str, run_words: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, span, high, low, again = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                seen = set()
                for a, b, unit in units(text.as_py() or "", run_words, least):
                    digest = xxhash.xxh3_128_intdigest(unit)
                    row.append(i)
                    span.append(a << 32 | b)
                    high.append(_signed(digest >> 64))
                    low.append(_signed(digest & (1 << 64) - 1))
                    again.append(digest in seen)
                    seen.add(digest)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(span, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(again, pa.bool_())],
                names=[key, "version", "span", "high", "low", "again"],
            )

    return run


def repeated_units(
    docs: DataFrame, key: str = "doc_id", run_words: int = RUN_WORDS, least: int = LEAST_WORDS
) -> DataFrame:
    """(key, version, span) of every unit whose content stands earlier in the corpus.

    The earliest occurrence is the one of the smallest key (NULL last), then of the smallest place in the
    text; rows of one key with different texts are ranked by ``version``, a hash of the text. ``span`` packs
    start and end, in characters of the original. Counting a digest combines map-side and the join is split
    by adaptive execution, so a line that stands in a third of all documents is no hot task.
    """
    found = docs.select(key, F.xxhash64("text").alias("version"), "text").mapInArrow(
        _unit_rows(key, run_words, least),
        f"`{key}` {key_type(docs, key)}, version bigint, span bigint, high bigint, low bigint, again boolean",
    )
    first = saved(
        found.filter("not again")
        .groupBy("high", "low")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.min_by("version", key).alias("of_first"),
            F.min("version").alias("of_null"),
        )
        .filter("n > 1")
        .select("high", "low", "first", F.coalesce("of_first", "of_null").alias("first_version"))
    )
    here = F.col(key).eqNullSafe(F.col("first")) & (F.col("version") == F.col("first_version"))
    # a unit that repeats inside its own document goes wherever the first one is kept
    gone = F.col("again") | (F.col("first_version").isNotNull() & ~here)
    return found.join(first, ["high", "low"], "left").filter(gone).select(key, "version", "span")


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", run_words: int = RUN_WORDS, least: int = LEAST_WORDS
) -> DataFrame:
    """Every row of ``docs`` with ``text`` cleaned and ``removed``: array of (start, end) cut from the original;
    spans of repeats that run into each other overlap.

    All columns are kept; a column of ``docs`` named ``removed`` is replaced. NULL text stays NULL, and a text
    without repeated units stays as it is, with an empty array. A row repeated with the same key and text is
    one document: its copies come out alike and are not cut by each other. A document all of whose units stand
    earlier comes out blank, for the caller to drop.
    """
    of_key, of_version, version, cuts = (fresh(docs, c) for c in ("_key", "_of", "_version", "_spans"))
    spans = (
        repeated_units(docs.select(key, "text"), key, run_words, least)
        .groupBy(key, "version")
        .agg(F.sort_array(F.collect_set("span")).alias(cuts))
        .select(F.col(key).alias(of_key), F.col("version").alias(of_version), cuts)
    )
    rest = [c for c in docs.columns if c not in ("text", "removed")]
    joined = docs.select(*rest, "text", F.xxhash64("text").alias(version)).join(
        spans, F.col(key).eqNullSafe(F.col(of_key)) & (F.col(version) == F.col(of_version)), "left"
    ).select(*rest, "text", cuts)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, packed in zip(batch.column(len(rest)), batch.column(len(rest) + 1)):
                cuts = [(x >> 32, x & 0xFFFFFFFF) for x in packed.as_py() or []]
                whole = text.as_py()
                texts.append(cut_out(whole, cuts) if cuts else whole)
                removed.append([{"start": a, "end": b} for a, b in cuts])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array(removed, kind)],
                names=[*rest, "text", "removed"],
            )

    schema = ", ".join([*fields, "text string", "removed array<struct<start: bigint, end: bigint>>"])
    return joined.mapInArrow(run, schema).select(*[c for c in docs.columns if c != "removed"], "removed")
