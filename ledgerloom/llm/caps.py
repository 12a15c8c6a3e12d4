"""Embedding near-duplicates by filters: spherical caps around the directions of structured random product codes."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved, spread
from ledgerloom.llm.components import connected_components

THRESHOLD = 0.9
# Filters of a vector in each code on average, codes, blocks of a code, vectors to a filter, and vectors compared at once.
FILTERS_EACH = 8
CODES = 6
# Above so many vectors two codes are added for each tenfold, as a pair shares fewer filters of a finer code.
CODES_UPTO = 1_000_000
BLOCKS = 2
TO_A_FILTER = 4
TOGETHER = 1024
# Inner products with directions held at once.
PRODUCTS = 1 << 22
# Random vectors that a cap is measured with, and how many times the mean number of filters is looked at of each.
MEASURED, REACH = 1024, 8
# More than any two products of unit vectors lie apart, and what searching allows for rounding before sums are compared.
WIDE, SLACK = 4.0, 1e-9
# Groups up to this size are compared by shifted rows instead of one product each.
SMALL = 24


@functools.lru_cache(maxsize=4 * CODES)
def _books(words: int, dim: int, nth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The nth code's rotation and, for each block of coordinates, its directions; the same in every task."""
    rng = np.random.default_rng([dim, nth])
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    books = []
    for part in np.array_split(np.arange(dim), min(BLOCKS, dim)):
        book = rng.standard_normal((words, len(part)))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
    return turn, books


def _sums(parts: list[np.ndarray], keep: list[int], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each row's largest products of every block, and the directions they are of."""
    reached, code = np.zeros((len(parts[0]), 1)), np.zeros((len(parts[0]), 1), dtype=np.int64)
    for part, n in zip(parts, keep):
        score, word = _largest(part, n)
        reached = (reached[:, :, None] + score[:, None, :]).reshape(len(part), -1)
        code = (code[:, :, None] * words + word[:, None, :]).reshape(len(part), -1)
    return reached, code


def _products(unit: np.ndarray, words: int, nth: int) -> list[np.ndarray]:
    turn, books = _books(words, unit.shape[1], nth)
    return [part @ book.T for part, book in zip(np.array_split(unit @ turn, len(books), axis=1), books)]


@functools.lru_cache(maxsize=4 * CODES)
def _cap(words: int, dim: int, nth: int, each: int) -> float:
    """Inner product that a unit vector has, or exceeds, with ``each`` directions of the nth code on average.

    Measured on random directions of the sphere, as every vector looks to a random rotation: the products of a code
    that is cut into blocks have a much thinner tail than normal ones.
    """
    x = np.random.default_rng([dim, nth, words]).standard_normal((MEASURED, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = max(1, PRODUCTS // words)
    sums = []
    for i in range(0, MEASURED, step):
        parts = _products(x[i : i + step], words, nth)
        found = _sums(parts, [REACH * each] * len(parts), words)[0]
        sums.append(_largest(found, REACH * each)[0].ravel())
    every = np.concatenate(sums)
    rank = min(len(every), each * MEASURED)
    return float(-np.partition(-every, rank - 1)[rank - 1])


@dataclass(frozen=True)
class Code:
    """Several codes, each a random rotation followed by ``words``^blocks directions: one of ``words`` random
    unit vectors in each block of coordinates.

    A vector is in the cap of, and so goes to, all directions with which its inner product exceeds a threshold: on
    average ``each`` of every code, some more and some less. The number of directions follows the number of vectors,
    so that a filter holds a few of them. A single code leaves some pairs with few shared filters, several even that
    out.
    """

    words: int
    each: int = FILTERS_EACH
    codes: int = CODES

    @staticmethod
    def of(n: int, each: int = FILTERS_EACH, codes: int = CODES) -> Code:
        more = max(0, math.ceil(2 * math.log10(max(n, 1) / CODES_UPTO)))
        return Code(max(8, math.ceil((max(n, 1) * each / TO_A_FILTER) ** (1 / BLOCKS))), each, codes + more)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every direction whose cap a row of ``unit`` is in, rows in order.

        Some rows at a time, as the directions of a block grow with the root of the number of vectors.
        """
        step = max(1, PRODUCTS // self.words)
        found = [self._decoded(unit[i : i + step], i) for i in range(0, max(1, len(unit)), step)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _decoded(self, unit: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """List decoding, block by block: a direction of a block can only reach the cap if it does so together with the
        best ones of the other blocks. Partial sums go on with as many of the next block's best directions as can still
        reach it, so the work follows the filters found and not all combinations."""
        rows, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for nth in range(self.codes if len(unit) else 0):
            cap = _cap(self.words, unit.shape[1], nth, self.each)
            parts = _products(unit, self.words, nth)
            most = [part.max(axis=1) for part in parts]
            row, reached, code = np.arange(len(unit)), np.zeros(len(unit)), np.zeros(len(unit), dtype=np.int64)
            for i, part in enumerate(parts):
                others = sum(most) - most[i]
                able, word = np.nonzero(part >= (cap - others - SLACK)[:, None])
                score = part[able, word]
                order = np.lexsort((-score, able))
                able, word, score = able[order], word[order], score[order]
                starts = np.searchsorted(able, np.arange(len(unit)))
                need = cap - reached - sum(most[i + 1 :], np.zeros(len(unit)))[row] - SLACK
                # scores fall within a row and rows follow each other, so one search finds each row's last able one
                upto = np.searchsorted(able * WIDE - score, row * WIDE - need, side="right")
                n = np.maximum(upto - starts[row], 0)
                at = np.repeat(starts[row] - np.cumsum(n) + n, n) + np.arange(n.sum())
                row, reached = np.repeat(row, n), np.repeat(reached, n) + score[at]
                code = np.repeat(code, n) * self.words + word[at]
            found = reached >= cap
            rows.append(row[found] + first)
            numbers.append(code[found] + nth * self.words ** len(parts))
        row, number = np.concatenate(rows), np.concatenate(numbers)
        order = np.argsort(row, kind="stable")
        return row[order], number[order]


def _largest(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` largest values of each row, in no order, and their places."""
    n = min(n, x.shape[1])
    at = np.argpartition(x, x.shape[1] - n, axis=1)[:, x.shape[1] - n :]
    return np.take_along_axis(x, at, axis=1), at


def _unit(vectors: list[list[float]]) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _entries(code: Code, payload: bool):
    """Rows (filter, dim[, id, copies, vec]) for every filter of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, len(whole), 512)):
                vectors = batch.column(2).to_pylist()
                for dim in sorted({len(v) for v in vectors}):
                    at = np.array([i for i, v in enumerate(vectors) if len(v) == dim])
                    row, number = code.decode(_unit([vectors[i] for i in at]))
                    take = pa.array(at[row])
                    columns = [pa.array(number), pa.array(np.full(len(row), dim, dtype=np.int32))]
                    if payload:
                        columns += [batch.column(k).take(take) for k in (0, 1, 2)]
                    names = ["filter", "dim", "id", "copies", "vec"][: len(columns)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _counted(code: Code, unit: np.ndarray, number: int) -> np.ndarray:
    """Matrix that is True where two members share a filter below ``number``: their pair is counted there."""
    row, filters = code.decode(unit)
    row, filters = row[filters < number], filters[filters < number]
    every, column = np.unique(filters, return_inverse=True)
    has = np.zeros((len(unit), len(every)), dtype=np.float32)
    has[row, column] = 1
    return has @ has.T > 0


def _group(code: Code, number: int, ids, copies, unit, threshold: float, across: np.ndarray | None):
    """Links of one filter's group: (ids, counted links, root by links inside the group)."""
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if across is not None:
        near &= across[:, None] != across[None, :]
    linked = near.any(axis=1)
    if not linked.any():
        return None
    near, ids, copies = near[np.ix_(linked, linked)], ids[linked], copies[linked]
    count = near & ~_counted(code, unit[linked], number)
    order = np.argsort(ids, kind="stable")
    label = np.empty(len(ids), dtype=np.int64)
    label[order] = np.arange(len(ids))
    by = ids[order]
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(ids)).min(axis=1))
        new = new[order][new]
        if np.array_equal(new, label):
            break
        label = new
    return ids, count.astype(np.int64) @ copies, by[label]


def _verify(code: Code, threshold: float):
    """Reads entries sorted by group, compares within each and gives (id, links, root)."""

    def groups(table: pa.Table, key: np.ndarray, cuts: np.ndarray):
        sizes = np.diff(cuts)
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        vec = table["vec"].combine_chunks()
        flat, ends = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64), vec.offsets.to_numpy()
        ends = ends - ends[0]
        norm = np.sqrt(np.add.reduceat(flat * flat, ends[:-1]))
        unit = flat / np.repeat(norm, np.diff(ends))
        # small groups: does any pair reach the threshold? compared with the row so many places on
        promising = sizes > SMALL
        member = np.repeat(np.arange(len(sizes)), sizes)
        dims = np.diff(ends)
        for lag in range(1, SMALL):
            i = np.flatnonzero((member[lag:] == member[:-lag]) & (sizes[member[lag:]] <= SMALL)) if lag < len(member) else []
            if not len(i):
                break
            for dim in np.unique(dims[i]):
                a = i[dims[i] == dim]
                spots = np.arange(dim)
                dots = np.einsum("ij,ij->i", unit[ends[a][:, None] + spots], unit[ends[a + lag][:, None] + spots])
                promising[member[a[dots >= threshold - 1e-9]]] = True
        for g in np.flatnonzero(promising):
            a, b = cuts[g], cuts[g + 1]
            across = table["side"].to_numpy()[a:b] if key[a, 2] != key[a, 3] else None
            members = unit[ends[a] : ends[b]].reshape(b - a, -1)
            found = _group(code, int(key[a, 0]), ids[a:b], copies[a:b], members, threshold, across)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = np.stack([held[c].to_numpy() for c in ("filter", "dim", "a", "b")], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1))
            if len(cuts) > 1:  # the last group may go on in the next batch
                done = held.slice(0, cuts[-1])
                yield from groups(done, key, cuts)
                held = held.slice(cuts[-1])
        if held is not None and len(held):
            key = np.stack([held[c].to_numpy() for c in ("filter", "dim", "a", "b")], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(held)]))
            yield from groups(held, key, cuts)

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", threshold: float = THRESHOLD,
    each: int = FILTERS_EACH, codes: int = CODES, together: int = TOGETHER,
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``vectors``; the key is an integer.

    Equal vectors are one node with its number of copies. Each vector goes to all filters whose cap it is in, vectors
    that share a filter are compared in double precision, and a pair is counted in the smallest filter the two
    share, so no list of pairs is ever made. A filter of more than ``together`` vectors is cut into that many
    parts, and each pair of parts is a group of its own, so that a crowd is many tasks. Every pair that shares
    a filter is compared. Vectors of different lengths never meet.

    A vector that is NULL, empty or zero, or holds a NULL or a component that is not finite, and a row with a
    NULL key, links with nothing: no links, its own component, kept. Rows that repeat a key count as further
    copies of their vector and take the links of all rows of the key.
    """
    number = F.col(vec)
    usable = (
        F.col(key).isNotNull() & number.isNotNull() & (F.size(number) > 0)
        & ~F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(number, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(key).cast("bigint").alias("id"), number.alias("vec"), F.coalesce(usable, F.lit(False)).alias("usable")
    )
    good = rows.filter("usable")
    kind = vectors.schema[vec].dataType.simpleString()
    nodes = saved(
        good.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies", "vec")
    )
    code = Code.of(nodes.count(), each, codes)
    schema = "filter bigint, dim int"
    crowded = saved(
        nodes.mapInArrow(_entries(code, False), schema).groupBy("filter", "dim").agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    hot = saved(crowded.filter(F.col("n") > together).withColumn("parts", F.ceil(F.col("n") / together).cast("int")))
    entries = nodes.mapInArrow(_entries(code, True), f"{schema}, id bigint, copies bigint, vec {kind}")
    side = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(spread("id") % F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
        lambda j: F.struct(F.least("side", j).alias("a"), F.greatest("side", j).alias("b")),
    )
    dealt = (
        entries.join(hot.select("filter", "dim", "parts"), ["filter", "dim"], "left")
        .withColumn("side", side)
        .select("filter", "dim", "id", "copies", "vec", "side", F.inline(pairs))
        .repartition("filter", "dim", "a", "b")
        .sortWithinPartitions("filter", "dim", "a", "b", "id")
    )
    found = saved(dealt.mapInArrow(_verify(code, threshold), "id bigint, links bigint, root bigint"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("id <> root"), "id", "root")
    named = saved(
        nodes.join(links, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    alone = rows.filter("not usable").select(
        F.col("id").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    linked = good.join(named, "vec").select(F.col("id").alias(key), "n_links", F.col("component").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
