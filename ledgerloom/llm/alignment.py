"""Alignment of two tokenizers: which of their ids cover the same bytes, and how often over a corpus."""

from __future__ import annotations

import base64
import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, saved, spread
from ledgerloom.llm.hpylm import packed, unpacked
from ledgerloom.llm.perfect_hash import PerfectHash, mixed

# Bytes of text in a chunk, chunks summed by one task, and most buckets of pairs.
CHUNK_BYTES = 4 << 20
TOGETHER = 1024
MOST_BUCKETS = 4096
# Ids fit 16 bits, so that a pair fits 32.
ID_BITS = 16
SPACE_MARK = "▁"
BYTE_PIECE = "<0x%02X>"


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level rank list (A) and a piece model (B); the installed public ones where none is given."""

    ranks: str | None = None
    model: str | None = None

    def load(self) -> Encoders:
        return _encoders(self.ranks, self.model)


class Encoders:
    """Both tokenizers with the bytes of every id. ``a`` and ``b`` hold the ids' bytes as Arrow arrays."""

    def __init__(self, ranks: str | None, model: str | None):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._first = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self._second = sentencepiece.SentencePieceProcessor(
            model_file=model or public_tokenizers.path("piece_bpe_32k.model")
        )
        a = [b""] * (max(merges.values()) + 1)
        for token, i in merges.items():
            a[i] = token
        single = {BYTE_PIECE % i: bytes([i]) for i in range(256)}
        pieces = [self._second.id_to_piece(i) for i in range(self._second.get_piece_size())]
        b = [single.get(p) or p.replace(SPACE_MARK, " ").encode() for p in pieces]
        if max(len(a), len(b)) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of up to {1 << ID_BITS} ids are supported")
        self.a, self.b = pa.array(a, pa.large_binary()), pa.array(b, pa.large_binary())
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], dtype=np.int64) for x in (a, b))
        # each id in decimal with the mark that follows it in the text of groups
        marked = [f"{i}{mark}".encode() for i in range(max(len(a), len(b))) for mark in ",|;"]
        self.marked = pa.array(marked, pa.large_binary())

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A over a space and the text, and of B over the text; none where either cannot give back the bytes."""
        none = np.zeros(0, dtype=np.uint16)
        if not text:
            return none, none
        whole = f" {text}".encode()
        a = np.array(self._first.encode_ordinary(f" {text}"), dtype=np.uint16)
        b = np.array(self._second.encode(text), dtype=np.uint16)
        if joined(self.a, a) != whole or joined(self.b, b) != whole:
            return none, none
        return a, b


def joined(of: pa.Array, at: np.ndarray) -> bytes:
    """The chosen byte strings end to end."""
    data = of.take(pa.array(at)).buffers()[2]
    return data.to_pybytes() if data else b""


@functools.lru_cache(maxsize=1)
def _encoders(ranks: str | None, model: str | None) -> Encoders:
    return Encoders(ranks, model)


class Alignment:
    """Links and groups of many documents at once: ``a`` and ``b`` are the ids of all, ``na`` and ``nb`` each one's.

    A document's tokens of A and of B cover the same bytes, so over all of them both are cuttings of one line. Each
    stretch between neighbouring cuts lies in one token of A and one of B, and two tokens that overlap share exactly
    one stretch: stretches are links. Where both cut, a group ends.
    """

    def __init__(self, encoders: Encoders, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray):
        self.marked, self.a, self.b, self.na, self.nb = encoders.marked, a, b, na, nb
        ends_a, ends_b = np.cumsum(encoders.a_sizes[a]), np.cumsum(encoders.b_sizes[b])
        cut = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, dtype=np.uint8)
        cut[ends_a] = 1
        cut[ends_b] |= 2
        at = np.flatnonzero(cut)
        self.cut = cut[at]
        self.both = self.cut == 3
        self._upto_a, self._upto_b = (np.cumsum(x, dtype=np.int64) for x in (self.cut & 1, self.cut >> 1))
        ia, ib = self._upto_a - (self.cut & 1), self._upto_b - (self.cut >> 1)
        self.keys = a[ia].astype(np.uint32) << np.uint32(ID_BITS) | b[ib] if len(a) else np.zeros(0, np.uint32)
        doc_bytes = np.concatenate(([0], ends_a))[np.cumsum(na)]
        self.ends = np.searchsorted(at, doc_bytes, side="right")

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over each document's links."""
        total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return total[self.ends] - total[np.concatenate(([0], self.ends[:-1]))]

    def groups(self) -> Iterator[memoryview]:
        """``a1,a2|b1;a3|b2`` of each document: decimal ids of its groups in order, empty without tokens."""
        if not len(self.a):
            yield from (memoryview(b"") for _ in self.na)
            return
        group = np.cumsum(self.both, dtype=np.int64) - self.both
        last_a, last_b = self._upto_a[self.both], self._upto_b[self.both]
        group_a, group_b = group[(self.cut & 1) == 1], group[self.cut >> 1 == 1]
        i, j = np.arange(len(self.a)), np.arange(len(self.b))
        order = np.empty(len(i) + len(j), dtype=np.int64)
        order[i + np.concatenate(([0], last_b))[group_a]] = self.a.astype(np.int64) * 3 + (i + 1 == last_a[group_a])
        order[j + last_a[group_b]] = self.b.astype(np.int64) * 3 + 2 * (j + 1 == last_b[group_b])
        text = self.marked.take(pa.array(order))
        starts = np.frombuffer(text.buffers()[1], dtype=np.int64)
        data = memoryview(text.buffers()[2])
        ends = np.cumsum(self.na + self.nb)
        for first, last in zip([0, *ends[:-1]], ends):
            yield data[starts[first] : starts[last] - 1] if last > first else data[:0]


def _flat(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a pair follows its B id alone, so that all pairs of a B id meet."""
    return (mixed(keys & np.uint32((1 << ID_BITS) - 1)) % np.uint64(buckets)).astype(np.int32)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of sorted distinct keys, which stay sorted within each bucket."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    for k, first, last in zip(found.tolist(), starts, [*starts[1:], len(order)]):
        yield k, order[first:last]


def _encode(vocabularies: Vocabularies, buckets: int, chunk_bytes: int):
    """First pass: for each chunk one row of its documents' ids and, for each bucket, its distinct pairs and counts.

    A chunk is what a task has read once the texts reach ``chunk_bytes``; its number holds the task's partition. The
    rows are written as one table before anything reads them, so a task that runs again replaces its own.
    """

    def flush(encoders: Encoders, chunk: int, names: pa.Array, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        na, nb = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        flat_a, flat_b = _flat(a, np.uint16), _flat(b, np.uint16)
        keys, counts = np.unique(Alignment(encoders, flat_a, flat_b, na, nb).keys, return_counts=True)
        rows = [(chunk, None, names.to_pylist(), packed(np.concatenate((na, nb))), packed(flat_a), packed(flat_b), None, None)]
        rows += [
            (chunk, k, None, None, None, None, packed(keys[at]), packed(counts[at].astype(np.int64)))
            for k, at in _by_bucket(keys, buckets)
        ]
        kinds = (pa.int64(), pa.int32(), pa.list_(names.type), *[pa.binary()] * 5)
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "names", "sizes", "a", "b", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = vocabularies.load()
        chunk, size, names, a, b = TaskContext.get().partitionId() << 32, 0, [], [], []
        for batch in batches:
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids = encoders(text)
                names.append(name)
                a.append(ids[0])
                b.append(ids[1])
                size += len(text or "")
                if size >= chunk_bytes:
                    yield flush(encoders, chunk, pa.array(names, kind), a, b)
                    chunk, size, names, a, b = chunk + 1, 0, [], [], []
        if names:
            yield flush(encoders, chunk, pa.array(names, kind), a, b)

    return run


def _union(rows: pa.Table) -> pa.Table:
    keys = [unpacked(x.as_py(), np.uint32) for x in rows["keys"]]
    whole = packed(np.unique(np.concatenate(keys)))
    return pa.table({"bucket": rows["bucket"][:1], "node": rows["node"][:1], "keys": pa.array([whole], pa.binary())})


def _hashed(rows: pa.Table) -> pa.Table:
    """A bucket's distinct pairs in the order of their perfect hash, and the hash."""
    keys = np.unique(np.concatenate([unpacked(x.as_py(), np.uint32) for x in rows["keys"]]))
    number = PerfectHash.of(keys)
    held = np.empty_like(keys)
    held[number(keys)] = keys
    columns = {"hash": pa.array([number.to_bytes()], pa.binary()), "keys": pa.array([packed(held)], pa.binary())}
    return pa.table({"bucket": rows["bucket"][:1], **columns})


def _counted(asked: pa.Table, hashes: pa.Table) -> pa.Table:
    """Some chunks' counts of one bucket as one dense vector, a place for each number of the perfect hash."""
    if not len(asked):  # none of these chunks has a pair of the bucket
        return pa.table({"bucket": hashes["bucket"][:0], "node": hashes["node"][:0], "counts": pa.array([], pa.binary())})
    number, held = PerfectHash.from_bytes(hashes["hash"][0].as_py()), unpacked(hashes["keys"][0].as_py(), np.uint32)
    dense = np.zeros(len(held), dtype=np.int64)
    for keys, counts in zip(asked["keys"], asked["counts"]):
        dense[number(unpacked(keys.as_py(), np.uint32))] += unpacked(counts.as_py(), np.int64)
    return pa.table({"bucket": asked["bucket"][:1], "node": asked["node"][:1], "counts": pa.array([packed(dense)], pa.binary())})


def _summed(rows: pa.Table) -> pa.Table:
    dense = unpacked(rows["counts"][0].as_py(), np.int64)
    for more in rows["counts"][1:]:
        dense = dense + unpacked(more.as_py(), np.int64)
    return pa.table({"bucket": rows["bucket"][:1], "node": rows["node"][:1], "counts": pa.array([packed(dense)], pa.binary())})


def _crowned(hashes: pa.Table, counts: pa.Table) -> pa.Table:
    """The bucket's table with a bit for each pair that no other pair of its B id exceeds."""
    held, dense = unpacked(hashes["keys"][0].as_py(), np.uint32), unpacked(counts["counts"][0].as_py(), np.int64)
    top = np.zeros(1 << ID_BITS, dtype=np.int64)
    b = held & np.uint32((1 << ID_BITS) - 1)
    np.maximum.at(top, b, dense)
    best = np.packbits(dense == top[b]).tobytes()
    return pa.table({
        "bucket": hashes["bucket"], "hash": hashes["hash"], "keys": hashes["keys"], "counts": counts["counts"],
        "best": pa.array([best], pa.binary()),
    })


def _looked_up(asked: pa.Table, tables: pa.Table) -> pa.Table:
    """For each chunk its pairs of the bucket with their counts over all documents."""
    rows = []
    if len(asked):
        number, held = PerfectHash.from_bytes(tables["hash"][0].as_py()), unpacked(tables["keys"][0].as_py(), np.uint32)
        dense = unpacked(tables["counts"][0].as_py(), np.int64)
        best = np.unpackbits(np.frombuffer(tables["best"][0].as_py(), np.uint8), count=len(held))
        for chunk, data in zip(asked["chunk"].to_pylist(), asked["keys"]):
            keys = unpacked(data.as_py(), np.uint32)
            at = number(keys)
            if (at < 0).any() or (held[at] != keys).any():
                raise RuntimeError("a pair of the first pass is not in the table of pairs")
            rows.append((chunk, data.as_py(), packed(dense[at]), np.packbits(best[at]).tobytes()))
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def _described(vocabularies: Vocabularies, key: str, digest: bool):
    """Second pass: aligns a chunk's documents again and looks up the counts of their links."""

    def run(encoded: pa.Table, answers: pa.Table) -> pa.Table:
        keys = [unpacked(x.as_py(), np.uint32) for x in answers["keys"]]
        best = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)) for x, k in zip(answers["best"], keys)]
        counts = _flat([unpacked(x.as_py(), np.int64) for x in answers["counts"]], np.int64)
        keys, best = _flat(keys, np.uint32), _flat(best, np.uint8)
        order = np.argsort(keys)
        keys, best, counts = keys[order], best[order], counts[order]
        na, nb = unpacked(encoded["sizes"][0].as_py(), np.int64).reshape(2, -1)
        ids = (unpacked(encoded[x][0].as_py(), np.uint16) for x in ("a", "b"))
        found = Alignment(vocabularies.load(), *ids, na, nb)
        at = np.searchsorted(keys, found.keys)
        if digest:
            groups = [hashlib.sha256(g).hexdigest() if len(g) else "" for g in found.groups()]
        else:
            groups = [bytes(g).decode() for g in found.groups()]
        columns = [
            na, nb, found.by_doc(found.both), found.by_doc(np.ones(len(found.keys))), found.by_doc(best[at]),
            found.by_doc(counts[at]), groups,
        ]
        names = encoded["names"].combine_chunks().flatten()
        return pa.table([names, *map(pa.array, columns)], names=[key, *OUT, "groups"])

    return run


OUT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass(frozen=True)
class Aligned:
    """What the first pass wrote: ids by chunk (``encoded``), and pairs by bucket with counts (``tables``)."""

    encoded: DataFrame
    asked: DataFrame
    tables: DataFrame
    chunks: int
    vocabularies: Vocabularies
    key: str

    def pairs(self) -> DataFrame:
        """(a_id, b_id, count, best) of every pair of ids that some link holds."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, counts, best in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    held = unpacked(keys, np.uint32).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(held >> ID_BITS, pa.int32()), pa.array(held & (1 << ID_BITS) - 1, pa.int32()),
                         pa.array(unpacked(counts, np.int64)),
                         pa.array(np.unpackbits(np.frombuffer(best, np.uint8), count=len(held)).astype(bool))],
                        names=["a_id", "b_id", "count", "best"],
                    )

        return self.tables.select("keys", "counts", "best").mapInArrow(run, "a_id int, b_id int, count bigint, best boolean")

    def documents(self, digest: bool = False, together: int = TOGETHER) -> DataFrame:
        """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

        ``groups`` is ``a1,a2|b1;a3|b2``, or its SHA-256 in hexadecimal with ``digest``, empty without tokens.
        """
        nodes = math.ceil(self.chunks / together)
        asked = self.asked.withColumn("node", _node("chunk", nodes))
        spread_out = self.tables.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
        answers = asked.groupBy("bucket", "node").cogroup(spread_out.groupBy("bucket", "node")).applyInArrow(
            _looked_up, "chunk bigint, keys binary, counts binary, best binary"
        )
        kind = self.encoded.schema["names"].dataType.elementType.simpleString()
        schema = f"`{self.key}` {kind}, {', '.join(f'{c} bigint' for c in OUT)}, groups string"
        return self.encoded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _described(self.vocabularies, self.key, digest), schema
        )


def _node(of: str, nodes: int):
    return (spread(of) % nodes).cast("int")


def _tree(rows: DataFrame, nodes: int, together: int, fold, schema: str) -> DataFrame:
    """Folds the rows of each bucket, ``together`` nodes to a task at a time, until a bucket is one row."""
    while nodes > 1:
        nodes = math.ceil(nodes / together)
        up = rows.withColumn("node", F.floor(F.col("node") / together).cast("int"))
        rows = saved(up.groupBy("bucket", "node").applyInArrow(fold, schema))
    return rows


def align(
    docs: DataFrame, key: str = "doc_id", vocabularies: Vocabularies = Vocabularies(), chunk_bytes: int = CHUNK_BYTES,
    together: int = TOGETHER, buckets: int | None = None,
) -> Aligned:
    """Aligns two tokenizers over every text of ``docs`` and counts the linked pairs of ids.

    A tokenizes a space and the text, B (which adds that space) the text, neither with special tokens. Two tokens are
    linked where their bytes overlap. The first pass tokenizes each text where it is read and writes the ids, with
    the distinct pairs of each chunk of texts, to the shared folder. Pairs are dealt to buckets by their B id; a
    bucket numbers its distinct pairs with a minimal perfect hash, chunks' counts become dense vectors under those
    numbers, and vectors are summed in a tree, ``together`` at a time. ``documents`` is the second pass: each chunk
    gets the counts of its own pairs, found by the hash and checked against the key kept there, and aligns its
    documents again. A task holds a chunk's ids (a longer text is a chunk of its own) or one bucket of some chunks;
    nothing goes through the driver and nothing is broadcast.

    A text that is NULL or empty, or that either tokenizer does not give back byte for byte, has no tokens: zeros and
    empty groups. Special tokens' strings are plain text. Repeated rows count and are returned each. NULL keys are
    kept. An empty table gives empty results. Columns other than the key and ``text`` are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    estimate = max(1, math.ceil(size / chunk_bytes))
    buckets = buckets or min(MOST_BUCKETS, max(16, 8 * math.ceil(math.sqrt(estimate))))
    kind = key_type(docs, key)
    first = docs.select(key, "text").mapInArrow(
        _encode(vocabularies, buckets, chunk_bytes),
        f"chunk bigint, bucket int, names array<{kind}>, sizes binary, a binary, b binary, keys binary, counts binary",
    )
    kept = saved(first)
    encoded = kept.filter("bucket IS NULL").select("chunk", "names", "sizes", "a", "b")
    asked = kept.filter("bucket IS NOT NULL").select("chunk", "bucket", "keys", "counts")
    chunks = max(1, encoded.count())

    nodes = math.ceil(chunks / together)
    by_node = asked.withColumn("node", _node("chunk", nodes))
    unions = by_node.select("bucket", "node", "keys")
    if nodes > 1:
        schema = "bucket int, node int, keys binary"
        unions = _tree(saved(unions.groupBy("bucket", "node").applyInArrow(_union, schema)), nodes, together, _union, schema)
    hashes = saved(unions.groupBy("bucket").applyInArrow(_hashed, "bucket int, hash binary, keys binary"))
    everywhere = hashes.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    schema = "bucket int, node int, counts binary"
    dense = by_node.groupBy("bucket", "node").cogroup(everywhere.groupBy("bucket", "node")).applyInArrow(_counted, schema)
    total = _tree(saved(dense), nodes, together, _summed, schema)
    tables = saved(hashes.groupBy("bucket").cogroup(total.groupBy("bucket")).applyInArrow(
        _crowned, "bucket int, hash binary, keys binary, counts binary, best binary"
    ))
    return Aligned(encoded, asked, tables, chunks, vocabularies, key)
