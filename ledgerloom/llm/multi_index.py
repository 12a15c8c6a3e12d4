"""Nearest neighbours by inner product: learned binary codes, an index for each part of them, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved, spread

# Bits of a code, rows the code is learned from, rounds of learning, queries the radius is measured with, and the
# share of their true neighbours that must lie within it.
BITS = 64
SAMPLE = 8192
ROUNDS = 30
MEASURED = 256
WITHIN = 0.97
# Rows of an index held by one task, queries probed together, and candidates compared at once.
REGION_ROWS = 32768
TOGETHER = 128
AT_ONCE = 1 << 20


def finite(vec: str) -> Column:
    """Whether a vector is there, has components, and none of them is NULL or not finite."""
    x = F.col(vec)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~odd, F.lit(False))


def usable(vec: str) -> Column:
    return finite(vec) & F.coalesce(F.exists(vec, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in one order wherever the rows stand."""
    return (x * y).sum(axis=1)


@dataclass(frozen=True)
class Coder:
    """Signs of learned projections. ``reach`` is the longest norm of any row.

    A row gets one more coordinate that brings its norm to ``reach`` and a query a zero there, so that larger inner
    products are smaller angles whatever the norms.
    """

    projection: np.ndarray
    offset: np.ndarray
    reach: float

    def __call__(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        scale = np.linalg.norm(x, axis=1, keepdims=True) if query else np.full((len(x), 1), self.reach)
        unit = np.concatenate((x / scale, np.zeros((len(x), 1))), axis=1)
        if not query:
            unit[:, -1] = np.sqrt(np.maximum(0.0, 1 - (unit * unit).sum(axis=1)))
        bits = unit @ self.projection > self.offset
        return (bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    @staticmethod
    def learned(sample: np.ndarray, reach: float, bits: int = BITS, rounds: int = ROUNDS) -> Coder:
        """Iterative quantization: principal directions, turned so that the rows lie close to their signs.

        Where a vector has fewer coordinates than the code has bits, further turns of the same directions follow, each
        learned from another random start.
        """
        rows = np.concatenate((sample / reach, np.zeros((len(sample), 1))), axis=1)
        rows[:, -1] = np.sqrt(np.maximum(0.0, 1 - (rows * rows).sum(axis=1)))
        mean = rows.mean(axis=0)
        directions = np.linalg.svd(rows - mean, full_matrices=False)[2][: rows.shape[1] - 1]
        blocks = []
        while (left := bits - sum(b.shape[1] for b in blocks)) > 0:
            kept = directions[:left].T
            shadow = (rows - mean) @ kept
            turn = np.linalg.qr(np.random.default_rng(len(blocks)).standard_normal((kept.shape[1], kept.shape[1])))[0]
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.where(shadow @ turn > 0, 1.0, -1.0).T @ shadow)
                turn = (u @ v).T
            blocks.append(kept @ turn)
        projection = np.concatenate(blocks, axis=1)
        return Coder(projection, mean @ projection, reach)


@dataclass(frozen=True)
class Index:
    """How codes are cut and how far is searched.

    A code is cut into ``parts`` substrings. By the pigeonhole principle a code within ``radius`` bits of a query's is
    within ``near(j)`` bits of it in at least one substring j, so looking into every such value of each substring
    finds all of them. Rows of one substring are dealt to regions by its first ``region_bits`` bits.
    """

    coder: Coder
    bits: int
    parts: int
    radius: int
    region_bits: int
    k: int

    @property
    def width(self) -> int:
        return math.ceil(self.bits / self.parts)

    def near(self, j: int) -> int:
        each, rest = divmod(self.radius, self.parts)
        return each if j <= rest else each - 1

    @property
    def tables(self) -> list[int]:
        """Substrings to look into: those with a radius; the first alone where that already covers every value."""
        if self.near(0) >= self.width:
            return [0]
        return [j for j in range(self.parts) if self.near(j) >= 0]

    def substring(self, codes: np.ndarray, j: int) -> np.ndarray:
        return codes >> np.uint64(j * self.width) & np.uint64((1 << self.width) - 1)

    def region(self, codes: np.ndarray, j: int) -> np.ndarray:
        return self.substring(codes, j) >> np.uint64(self.width - self.region_bits)


def _coded(coder: Coder, query: bool):
    """(id, vec, code) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                code = pa.array(coder(matrix(batch.column(1)), query).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code], names=["id", "vec", "code"])

    return run


def _probes(index: Index):
    """(j, region, id, vec, code) for every region of each substring that holds values near enough to a query's."""
    every = np.arange(1 << index.region_bits, dtype=np.uint64)
    weight = np.bitwise_count(every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(2).to_numpy().view(np.uint64)
            for j in index.tables:
                flips = every[weight <= index.near(j)]
                step = max(1, (1 << 14) // len(flips))
                for i in range(0, len(batch), step):
                    some = batch.slice(i, step)
                    region = index.region(codes[i : i + step], j)[:, None] ^ flips
                    take = pa.array(np.repeat(np.arange(len(some)), len(flips)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(region.size, j, np.int32)), pa.array(region.ravel().astype(np.int64)),
                         *(some.column(k).take(take) for k in range(3))],
                        names=["j", "region", "id", "vec", "code"],
                    )

    return run


class Shelf:
    """One region of one substring's index: rows ordered by the substring's value, with a directory of values."""

    def __init__(self, index: Index, j: int, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        value = index.substring(codes, j)
        order = np.argsort(value, kind="stable")
        self.index, self.j = index, j
        self.ids, self.vectors, self.codes = ids[order], vectors[order], codes[order]
        self.values, self.starts, self.sizes = np.unique(value[order], return_index=True, return_counts=True)

    def _candidates(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) places of all rows whose substring is near a query's, some at a time."""
        value = self.index.substring(codes, self.j)
        q, v = np.nonzero(np.bitwise_count(value[:, None] ^ self.values) <= self.index.near(self.j))
        upto = np.cumsum(self.sizes[v])
        first = 0
        while first < len(v):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + AT_ONCE, side="right")))
            sizes = self.sizes[v[first:last]]
            before = np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield np.repeat(q[first:last], sizes), np.repeat(self.starts[v[first:last]], sizes) + np.arange(len(before)) - before
            first = last

    def _within(self, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Codes within the radius that no earlier substring's index finds."""
        apart = mine ^ theirs
        near = np.bitwise_count(apart) <= self.index.radius
        for i in self.index.tables:
            if i < self.j:
                near &= np.bitwise_count(self.index.substring(apart, i)) > self.index.near(i)
        return near

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query, row, score) of each query's best rows here, best first, by exact inner products."""
        k = self.index.k
        floor = np.full(len(ids), -np.inf)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for q, row in self._candidates(codes):
            keep = self._within(codes[q], self.codes[row]) & (ids[q] != self.ids[row])
            q, row = q[keep], row[keep]
            score = np.concatenate([np.zeros(0), *[
                products(vectors[q[i : i + 16384]], self.vectors[row[i : i + 16384]]) for i in range(0, len(q), 16384)
            ]])
            keep = score >= floor[q]
            q, row, score = (np.concatenate((a, b[keep])) for a, b in zip(held, (q, row, score)))
            order = np.lexsort((self.ids[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            start = np.searchsorted(q, q, side="left")
            keep = np.arange(len(q)) - start < k
            held = q[keep], row[keep], score[keep]
            full = np.flatnonzero(np.arange(len(q)) - start == k - 1)
            floor[q[full]] = score[full]
        return held


def _probed(index: Index):
    """Reads groups sorted with rows before queries; keeps one group's rows, lets its queries pass."""

    def answers(shelf: Shelf, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(some), TOGETHER):
            part = some.slice(i, TOGETHER)
            ids, codes = part.column("id").to_numpy(), part.column("code").to_numpy().view(np.uint64)
            q, row, score = shelf.nearest(ids, matrix(part.column("vec")), codes)
            found, starts = np.unique(q, return_index=True)
            ends = pa.array(np.append(starts, len(q)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[found]), pa.ListArray.from_arrays(ends, pa.array(shelf.ids[row])),
                 pa.ListArray.from_arrays(ends, pa.array(score))],
                names=["query_id", "ids", "scores"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, shelf = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("j", "region", "part", "query")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                *group, query = key[a].tolist()
                if group != at:
                    at, rows, shelf = group, [], None
                if not query:
                    rows.append(batch.slice(a, b - a))
                elif rows or shelf:
                    if shelf is None:
                        ids, codes = (np.concatenate([r.column(c).to_numpy() for r in rows]) for c in ("id", "code"))
                        vectors = np.concatenate([matrix(r.column("vec")) for r in rows])
                        shelf, rows = Shelf(index, group[0], ids, vectors, codes.view(np.uint64)), []
                    yield from answers(shelf, batch.slice(a, b - a))

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; partial bests are taken before the shuffle."""
    each = found.select("query_id", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(index: Index, rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Top rows of each query among codes within the radius. ``rows`` and ``queries`` are (id, vec, code)."""
    j = F.explode(F.array(*[F.lit(t) for t in index.tables]))
    at = (F.col("j") * index.width).cast("int")
    value = F.call_function("shiftrightunsigned", F.col("code"), at).bitwiseAND(F.lit((1 << index.width) - 1))
    region = F.shiftrightunsigned(value, index.width - index.region_bits)
    entries = rows.withColumn("j", j).withColumn("region", region.cast("bigint"))
    sizes = saved(
        entries.groupBy("j", "region").agg(F.count(F.lit(1)).alias("n"))
        .select("j", "region", F.ceil(F.col("n") / REGION_ROWS).cast("int").alias("parts"))
    )
    kind = rows.schema["vec"].dataType.simpleString()
    probes = queries.mapInArrow(_probes(index), f"j int, region bigint, id bigint, vec {kind}, code bigint")
    columns = ("j", "region", "part", "query", "id", "vec", "code")
    dealt = entries.join(sizes, ["j", "region"]).withColumns(
        {"part": (spread("id", "code") % F.col("parts")).cast("int"), "query": F.lit(0)}
    ).select(*columns).unionByName(
        probes.join(sizes, ["j", "region"])
        .withColumns({"part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "query": F.lit(1)}).select(*columns)
    )
    ordered = dealt.repartition("j", "region", "part").sortWithinPartitions("j", "region", "part", "query")
    return _best(ordered.mapInArrow(_probed(index), "query_id bigint, ids array<bigint>, scores array<double>"), index.k)


def _drawn(rows: DataFrame, n: int, total: int) -> DataFrame:
    """At most ``n`` rows, the same ones however the table is dealt."""
    at = spread("id", "vec")
    few = rows.filter((at % 1_000_003) / 1_000_003.0 < min(1.0, 1.5 * n / max(1, total) + 1e-9))
    return few.orderBy(at, "id").limit(n)


def _measured(coder: Coder, ids: np.ndarray, vectors: np.ndarray, k: int):
    """(query_id, ids, scores, apart) of the k best rows of a task for each of a few queries, with bits apart."""
    mine = coder(vectors, query=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(ids), 0))
        their, apart = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), np.int32)
        for batch in batches:
            found, codes = batch.column(0).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            new = vectors @ matrix(batch.column(1)).T
            new[ids[:, None] == found] = -np.inf
            score = np.concatenate((score, new), axis=1)
            their = np.concatenate((their, np.broadcast_to(found, new.shape)), axis=1)
            apart = np.concatenate((apart, np.bitwise_count(mine[:, None] ^ codes).astype(np.int32)), axis=1)
            at = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, their, apart = (np.take_along_axis(x, at, axis=1) for x in (score, their, apart))
        q, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q]), pa.array(their[q, at]), pa.array(score[q, at]), pa.array(apart[q, at])],
            names=["query_id", "vec_id", "score", "apart"],
        )

    return run


def build(rows: DataFrame, queries: DataFrame, k: int, bits: int = BITS, sample: int = SAMPLE, measured: int = MEASURED,
          within: float = WITHIN) -> tuple[Index, DataFrame] | None:
    """Learns the code, writes every row with its code, and measures the radius that searching needs.

    The code is learned from at most ``sample`` rows. At most ``measured`` queries are compared with every row, and the
    radius is the distance in bits within which ``within`` of their true neighbours lie. Substrings have about as many
    bits as the number of rows needs, at least two of them.
    """
    total, reach = rows.agg(F.count(F.lit(1)), F.max(F.aggregate(
        "vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"), F.sqrt
    ))).first()
    few = _drawn(queries, measured, queries.count()).toArrow()
    if not total or not len(few):
        return None
    drawn = matrix(_drawn(rows, sample, total).toArrow()["vec"].combine_chunks())
    coder = Coder.learned(drawn, reach * (1 + 1e-9), bits)
    kind = rows.schema["vec"].dataType.simpleString()
    coded = saved(rows.mapInArrow(_coded(coder, False), f"id bigint, vec {kind}, code bigint"))
    exact = coded.mapInArrow(
        _measured(coder, few["id"].to_numpy(), matrix(few["vec"].combine_chunks()), k),
        "query_id bigint, vec_id bigint, score double, apart int",
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    radius = true.agg(F.percentile("apart", F.lit(within))).first()[0]
    parts = max(2, round(bits / max(1.0, math.log2(total))))
    width = math.ceil(bits / parts)
    region_bits = min(width, 16, max(0, math.ceil(math.log2(total / REGION_ROWS))))
    return Index(coder, bits, parts, math.ceil(radius or 0), region_bits, k), coded


def nearest(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 20, bits: int = BITS,
    sample: int = SAMPLE, measured: int = MEASURED, within: float = WITHIN,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` rows of ``vectors`` found nearest to each row of ``queries``.

    Both hold an integer key and a vector. Nearness is the inner product of the original vectors in double precision,
    ties go to the smaller key, and rows of a query's own key are no candidates of it. Every row is indexed by its
    code (see ``build``); a task holds one part of a region of one substring's index and lets the region's queries
    pass, so a value that many rows share is several tasks. Each pair of codes within the radius is reranked once.
    Queries that find fewer than ``k`` are searched again without a radius, so that none is left short while there
    are candidates.

    Rows with a NULL key or vector, a zero vector, or a NULL or non-finite component take no part, nor do vectors of
    another length than most. Of query rows that repeat a key the smallest vector counts; other rows that repeat a key
    are candidates each. An empty table gives an empty result.
    """
    good = vectors.filter(F.col(key).isNotNull() & usable(vec)).select(
        F.col(key).cast("bigint").alias("id"), F.col(vec).alias("vec")
    )
    lengths = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = lengths.n if lengths else 0
    rows = good.filter(F.size("vec") == length)
    asked = (
        queries.filter(F.col(key).isNotNull() & usable(vec) & (F.size(vec) == length))
        .groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(vec).alias("vec"))
    )
    built = build(rows, asked, k, min(bits, 64), sample, measured, within)
    if not built:
        none = asked.filter("false")
        return none.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    index, coded = built
    kind = rows.schema["vec"].dataType.simpleString()
    sought = saved(asked.mapInArrow(_coded(index.coder, True), f"id bigint, vec {kind}, code bigint"))
    found = saved(_search(index, coded, sought))
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = saved(sought.join(full, "id", "left_anti"))
    if not short.isEmpty():
        every = _search(replace(index, radius=index.bits), coded, short)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(every)
    return found.select("query_id", "rank", "vec_id", "score")
