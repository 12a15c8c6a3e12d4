"""Sum-of-squares packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, spread

CAPACITY = 1024
END_ID = 2
# Documents packed together by one task, on average.
SHARD_DOCS = 4096
SPECIAL = "<|endoftext|>"


class Tokens:
    """Ids of the byte-level vocabulary. The rank file gives the ids of the JSON file several times faster;
    a text that holds the special token goes through the JSON file itself."""

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.exact = Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        if SPECIAL in text:
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", vocabulary: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every document's ids, the end id included.

    Only a document longer than ``capacity`` is cut; all of its pieces are full but the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokens(vocabulary, ranks)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py()), END_ID], dtype="<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    schema = f"`{key}` {key_type(docs, key)}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(key, "text").mapInArrow(run, schema)


def sum_of_squares(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size, placed in the order given.

    Each goes into the open bin that makes the sum, over residual gaps, of the squared number of open bins
    with that gap smallest; among equals into the smallest gap. A bin is opened only when none has room, so
    that decreasing sizes leave few gaps.
    """
    n_open = np.zeros(capacity + 1, dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    no_room = np.iinfo(np.int64).max
    made = 0
    for i, s in enumerate(sizes.tolist()):
        gap = capacity
        if s < capacity:
            before = n_open[s:capacity]
            change = 2 * (n_open[: capacity - s] - before) + 2
            change[0] = 1 - 2 * before[0]  # a full bin is no longer open
            change[before == 0] = no_room
            at = int(change.argmin())
            if change[at] != no_room:
                gap = at + s
        if gap == capacity:
            chosen, made = made, made + 1
        else:
            chosen = waiting[gap].pop()
            n_open[gap] -= 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > s:
            n_open[gap - s] += 1
            waiting[gap - s].append(chosen)
    return bins, offsets


def pack(
    docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", shard_docs: int = SHARD_DOCS,
    vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Documents are dealt by hash to shards of about ``shard_docs``; their number grows with the table, so a
    task packs the same number at every size. Only piece records move, never texts or ids. A shard places its
    pieces in decreasing order of length, ties by key, piece and checksum, and numbers its sequences within a
    range of its own. NULL and empty text is the end id alone. Repeated rows are packed each. A NULL key is
    dealt by its pieces' content. An empty table gives an empty result.
    """
    # counted from the files' footers when docs is a plain scan
    shards = max(1, math.ceil(docs.count() / shard_docs))
    cut = pieces(docs, capacity, key, vocabulary, ranks)
    dealt = cut.withColumn("shard", (spread(key, "start", "ids_crc32") % shards).cast("int"))
    kind = key_type(docs, key)

    def run(part: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", key, "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.drop(columns="shard").assign(sequence_id=bins + (int(part[0]) << 40), offset=offsets)

    schema = (
        f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    return dealt.groupBy("shard").applyInPandas(run, schema)
