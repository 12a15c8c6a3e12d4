"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, saved, words
from ledgerloom.llm.components import connected_components

BITS = 64
SHINGLE = 4
SEED = 42
RADIUS = 4
# A bucket up to this size is compared whole in one step of numpy; larger ones go through midpoints.
BLOCK = 4096
SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64. No word: zero."""
    ws = words(text)
    if not ws:
        return 0
    line = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(ws) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[min(shingle, len(ws)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, SLICE):
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[at : at + SLICE], ends[at : at + SLICE])], dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint of each whole text as a signed long. NULL text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {key_type(docs, key)}, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that two words differing in at most ``radius`` bits agree on some mask.

    Bit i has a nonzero vector of radius+1 binary digits, mask v keeps the bits whose vector has an odd inner
    product with v. At most ``radius`` differing bits span fewer than radius+1 dimensions, so some nonzero v
    is orthogonal to all of them and its mask leaves them out.
    """
    size = 2 ** (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each of sorted fingerprints, the index of the smallest it reaches by links inside this bucket."""
    n = len(fps)
    label = np.arange(n)
    u = fps.view(np.uint64)
    step = max(1, (1 << 20) // n)
    close = [np.bitwise_count(u[i : i + step, None] ^ u[None, :]) <= radius for i in range(0, n, step)]
    while True:
        new = np.concatenate([np.where(c, label[None, :], n).min(axis=1) for c in close])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _bucket_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for bucket in batch.column(0):
                fps = np.sort(np.unique(np.array(bucket.as_py(), dtype=np.int64)))
                label = near(fps, radius)
                moved = label != np.arange(len(fps))
                left.append(fps[moved])
                right.append(fps[label[moved]])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"]
                )

    return run


def _midpoint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Exact links among fingerprints too close together to compare all pairs of a bucket.

    Two words within ``radius`` bits (an even number) share a word within half of it of both, and any two that
    share one are within ``radius``. So each fingerprint is linked to the smallest one at each of its
    midpoints: a fixed number of rows per fingerprint, however many lie close together.
    """
    flips, frontier = [0], [(0, -1)]
    for _ in range(radius // 2):
        frontier = [(m | 1 << j, j) for m, last in frontier for j in range(last + 1, BITS)]
        flips += [m for m, _ in frontier]
    flip = F.explode(F.lit([_signed(m) for m in flips]).cast("array<bigint>"))
    points = fps.select("fp", flip.alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    least = saved(
        points.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    return points.join(least, "point").select(F.col("fp").alias("a"), "b").filter("a <> b").distinct()


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all fingerprints ``fp`` within ``radius`` bits, not one row for each pair.

    ``distinct`` holds each fingerprint once. Every pair within the radius agrees on some mask. A bucket of
    two is checked in SQL; one of up to ``block`` is compared whole and gives a spanning forest; the members
    of larger ones meet at midpoints, exactly and without listing pairs.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = [
        F.struct(F.lit(i).cast("smallint").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(covering_masks(radius))
    ]
    cells = distinct.select("fp", F.inline(F.array(*masks)))
    crowded = saved(
        cells.groupBy("mask", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("b"), F.max("fp").alias("a"))
        .filter("n > 1")
    )
    pairs = crowded.filter("n = 2").select("a", "b").filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    )
    members = cells.join(crowded.filter("n > 2").select("mask", "part", "n"), ["mask", "part"])
    buckets = members.filter(F.col("n") <= block).groupBy("mask", "part").agg(F.collect_list("fp").alias("fps"))
    found = buckets.select("fps").mapInArrow(_bucket_links(radius), "a bigint, b bigint")
    links = pairs.unionByName(found)
    if crowded.filter(F.col("n") > block).limit(1).count():
        hot = saved(members.filter(F.col("n") > block).select("fp").distinct())
        links = links.unionByName(_midpoint_links(hot, radius))
    return links


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(key, fp, component_id) for every row of ``docs``.

    The component is the smallest key reachable over fingerprints that differ in at most ``radius`` bits.
    Equal fingerprints are one node, so exact copies cost nothing beyond their row. NULL or blank text has
    fingerprint zero and links like any other. Rows with a NULL key take the smallest key of their group, NULL
    if all are; repeated rows come out repeated. An empty table gives an empty result.
    """
    marked = saved(fingerprints(docs, key, text, shingle))
    nodes = saved(marked.groupBy("fp").agg(F.min(key).alias("first")))
    groups = connected_components(fingerprint_links(nodes.select("fp"), radius), "a", "b")
    grouped = saved(
        nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component")
        )
    )
    smallest = saved(grouped.groupBy("component").agg(F.min("first").alias("component_id")))
    names = saved(grouped.join(smallest, "component").select("fp", "component_id"))
    return marked.join(names, "fp").select(key, "fp", "component_id")
