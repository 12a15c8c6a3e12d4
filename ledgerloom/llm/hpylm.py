"""Hierarchical Pitman-Yor language model of word pairs, seated by Gibbs sampling across the cluster.

Every previous word has a restaurant whose tables are customers of one shared parent, the restaurant of single
words, over a uniform base. Documents are dealt to chunks; a chunk holds the distinct words and pairs of its
documents as sorted hashes and asks for their counts, part by part of the hash range. A message is one row for
a chunk and a part with columns of bytes, so what moves is the distinct words and pairs, not the tokens.
Documents move as compressed bundles.
"""

from __future__ import annotations

import functools
import gc
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import key_type, remainder, saved, spread

# No word is empty or a space: they stand for the end of a text and for what comes before its first word.
END, START = b"", b" "
START_KEY = np.uint64(xxhash.xxh64_intdigest(START))
LEAST_CHUNKS = 32
CHUNK_BYTES = 4_000_000
# A pair's key has at least this many bits more than it takes to count the corpus's bytes, in whole bytes: less
# than one pair in a hundred thousand shares its key.
SPARE_BITS = 18
# Up to so many customers the steps of the Stirling numbers are a table of all sizes.
SECTION = 32
# Above, rows of steps up to so many tables are kept for some sizes: all up to the first, then sizes a hundredth apart.
# They follow the exact recurrence up to the second, and its differential equation after.
WIDTH, EVERY, EXACT = 2048, 1024, 4096
_SHRINK, _EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_SLICE = 1 << 20
MESSAGE = "chunk int, part int, kind string, x0 binary, x1 binary, x2 binary, x3 binary, s0 bigint, s1 bigint, s2 bigint, s3 bigint"
_FIELDS = ["chunk", "part", "kind", "x0", "x1", "x2", "x3", "s0", "s1", "s2", "s3"]


@dataclass(frozen=True)
class Model:
    """What all tasks know: sizes of the corpus, discounts, and of each round the root's customers and tables."""

    bits: int
    key_bits: int = 56
    tokens: int = 0
    distinct: int = 0
    discount: float = 0.5
    root_discount: float = 0.5
    strength: float = 1.0
    customers: tuple[int, ...] = ()
    tables: tuple[int, ...] = ()

    def root(self, m: np.ndarray, t: np.ndarray, nth: int) -> np.ndarray:
        """Probability of words with ``m`` customers at ``t`` tables of the root, in the nth round."""
        spare = (self.strength + self.root_discount * self.tables[nth]) / (self.distinct + 1)
        return (np.maximum(m - self.root_discount * t, 0) + spare) / (self.strength + self.customers[nth])

    def draw(self, keys: np.ndarray, c: np.ndarray, parent: np.ndarray, others: np.ndarray, nth: int) -> np.ndarray:
        """Tables of pairs with ``c`` customers in the nth round, given the parent's probability of the word and
        the restaurant's tables in the round before. The same pair draws the same in every task."""
        strength = self.strength + self.discount * np.maximum(others - 1, 0)
        return tables(keys + np.uint64(nth), c, parent, strength, self.discount)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    return _paired(_mixed(before), word, bits)


def _paired(mixed: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    return _mixed(mixed * np.uint64(3) + word) & ~np.uint64((1 << 64 - bits) - 1)


_STEPS: dict[float, np.ndarray] = {}


def stirling_steps(discount: float) -> np.ndarray:
    """S(c, t + 1) / S(c, t) of the generalised Stirling numbers, for c and t up to SECTION; zero from t = c on."""
    if discount not in _STEPS:
        table = np.zeros((SECTION + 1, SECTION + 2))
        table[1, 1] = 1.0
        for c in range(1, SECTION):
            t = np.arange(1, c + 2)
            table[c + 1, 1 : c + 2] = table[c, : c + 1] + np.maximum(c - t * discount, 0) * table[c, 1 : c + 2]
        _STEPS[discount] = np.divide(table[:, 1:], table[:, :-1], out=np.zeros((SECTION + 1, SECTION + 1)), where=table[:, :-1] > 0)
    return _STEPS[discount]


class Steps:
    """S(c, t + 1) / S(c, t) for any c above SECTION, of one discount; sizes are added as larger ones are asked for.

    A ratio depends on those of one customer less at t and t - 1 alone, so rows cut at WIDTH are right up to there.
    """

    def __init__(self, discount: float):
        self.discount, self.c, self.now = discount, 1, np.zeros(WIDTH)
        self.every = np.zeros((EVERY + 1, EVERY), dtype=np.float32)
        self.sizes, self.rows = np.array([EVERY]), np.zeros((1, WIDTH), dtype=np.float32)

    def _next(self) -> None:
        """One customer more; above EXACT some, towards the value at which a ratio rests given its neighbour."""
        d, t, c = self.discount, np.arange(1, WIDTH + 1), self.c
        with np.errstate(divide="ignore", invalid="ignore"):
            before = np.concatenate(([0.0], 1 / self.now[:-1]))
            if c < EXACT:
                self.now, self.c = (1 + (c - (t + 1) * d) * self.now) / (before + c - t * d), c + 1
                self.now[min(c, WIDTH):] = 0
                return
            more = max(1, c // 500)
            rest, rate = 1 / (before + d), (before + d) / (1 + (before - t * d) / c)
            # the neighbour moves meanwhile: once more with the mean of it before and after
            new = rest + (self.now - rest) * (1 + more / c) ** -rate
            before = np.concatenate(([0.0], 2 / (self.now + new)[:-1]))
            rest, rate = 1 / (before + d), (before + d) / (1 + (before - t * d) / (c + more / 2))
            self.now, self.c = rest + (self.now - rest) * (1 + more / c) ** -rate, c + more

    def reach(self, c: int) -> None:
        sizes, rows = [], []
        while self.c < EVERY or self.sizes[-1] < c and not (sizes and sizes[-1] >= c):
            self._next()
            if self.c <= EVERY:
                self.every[self.c] = self.now[:EVERY]
                self.rows[0] = self.now
            elif self.c >= (sizes or self.sizes)[-1] * 1.01:
                sizes.append(self.c)
                rows.append(self.now.astype(np.float32))
        if sizes:
            self.sizes, self.rows = np.concatenate((self.sizes, sizes)), np.concatenate((self.rows, rows))

    def __call__(self, c: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """For each of ``c`` the steps from 1, 2 .. ``upto`` tables, in rows as long as the longest; zero from t = c on."""
        self.reach(int(c.max()))
        steps, some = np.zeros((len(c), int(upto.max()))), c <= EVERY
        width = min(steps.shape[1], EVERY)
        steps[some, :width] = self.every[c[some], :width]
        if not some.all():
            many, width = np.flatnonzero(~some), min(steps.shape[1], WIDTH)
            high = np.searchsorted(self.sizes, c[many])
            low, high = self.sizes[high - 1], high
            share = (np.log(c[many] / low) / np.log(self.sizes[high] / low))[:, None]
            steps[many, :width] = share * self.rows[high, :width] + (1 - share) * self.rows[high - 1, :width]
            # of many tables among sizes apart, and beyond WIDTH
            for i in many[upto[many] > np.minimum(c[many] // 4, WIDTH)]:
                beyond = min(int(c[i]) // 4, WIDTH)
                steps[i, beyond : upto[i]] = saddle_steps(self.discount, int(c[i]), np.arange(beyond + 1, upto[i] + 1))
        return steps


def saddle_steps(discount: float, c: int, t: np.ndarray) -> np.ndarray:
    """S(c, t + 1) / S(c, t) for many tables, from S(c, t) = c! / (t! d^t) [z^c] (1 - (1 - z)^d)^t at its saddle."""
    d, each = discount, np.append(t, t[-1] + 1).astype(np.float64) if len(t) else np.zeros(0)
    if not len(t):
        return each
    low, high = np.full(len(each), -700.0), np.zeros(len(each))  # log(1 - z)
    for _ in range(60):
        mid = (low + high) / 2
        w = np.exp(mid)
        above = -np.expm1(mid) * d * w ** (d - 1) * each > c * -np.expm1(d * mid)
        low, high = np.where(above, mid, low), np.where(above, high, mid)
    w = np.exp((low + high) / 2)
    z, f = 1 - w, 1 - w**d
    slope = z * d * w ** (d - 1) / f  # z f' / f
    variance = slope * (1 + z * (1 - d) / w - slope)
    # t = c is z = 0, where all is one term
    last = each >= c
    value = np.where(last, 0.0, each * np.log(np.where(last, 1, f)) - c * np.log(np.where(last, 1, z)) - np.log(np.where(last, 1, 2 * np.pi * each * variance)) / 2)
    value = np.where(last, c * np.log(d), value)
    return np.exp(np.diff(value)) / (each[1:] * d)


_ALL_STEPS: dict[float, Steps] = {}


def _tables_of_many(keys: np.ndarray, c: np.ndarray, parent: np.ndarray, strength: np.ndarray, discount: float) -> np.ndarray:
    """``tables`` for dishes of more than SECTION customers.

    S(c, t + 1) / S(c, t) stays below 1 / (t d), so the tables after the first stay below a negative binomial,
    and the sum ends where nothing of that is left.
    """
    if discount not in _ALL_STEPS:
        _ALL_STEPS.clear()  # one discount at a time: rows take memory and are soon made again
        _ALL_STEPS[discount] = Steps(discount)
    steps_of = _ALL_STEPS[discount]
    uniform = (_mixed(keys) >> np.uint64(11)).astype(np.float64) / 2.0**53
    p = np.minimum(parent, 1 - 1e-9)
    mean = (strength / discount + 1) * p / (1 - p)
    upto = np.minimum(c - 1, np.ceil(mean + 8 * np.sqrt(mean / (1 - p)) - 36 / np.log(p))).astype(np.int64)
    out, order, a = np.ones(len(c), dtype=np.int64), np.lexsort((upto, mean > 500)), 0
    few = int((mean <= 500).sum())
    while a < len(c):
        # some of like width at once
        stop = few if a < few else len(c)
        b = a + int(np.searchsorted(upto[order[a:stop]], max(16, 3 * upto[order[a]] // 2), side="right"))
        b = min(b, a + max(1, (1 << 16) // int(upto[order[b - 1]])))
        at = order[a:b]
        more = steps_of(c[at], upto[at])
        more *= parent[at][:, None] * (strength[at][:, None] + discount * np.arange(1, more.shape[1] + 1))
        if a < few:  # the largest weight is below exp(mean)
            weight = np.cumprod(more, axis=1, out=more)
            top = np.ones(len(at))
        else:
            with np.errstate(divide="ignore"):
                weight = np.cumsum(np.log(more), axis=1)
            top = np.maximum(weight.max(axis=1), 0)
            weight, top = np.exp(weight - top[:, None]), np.exp(-top)
        upper = np.cumsum(weight, axis=1, out=weight) + top[:, None]
        bar = uniform[at] * upper[:, -1]
        out[at] = 1 + (bar >= top) + (upper[:, :-1] <= bar[:, None]).sum(axis=1)
        a = b
    return np.minimum(out, c)


def tables(keys: np.ndarray, c: np.ndarray, parent: np.ndarray, strength: np.ndarray, discount: float) -> np.ndarray:
    """One blocked Gibbs draw of each dish's number of tables from its exact conditional.

    P(t) is proportional to S(c, t) * parent^t * strength (strength + d) ... (strength + (t - 1) d), the seating
    of all other dishes fixed.
    """
    if len(c) and c.max() > SECTION:
        big = c > SECTION
        out = np.empty(len(c), dtype=np.int64)
        out[~big] = tables(keys[~big], c[~big], parent[~big], strength[~big], discount)
        out[big] = _tables_of_many(keys[big], c[big], parent[big], strength[big], discount)
        return out
    out = np.minimum(c, 1).astype(np.int64)
    uniform = (_mixed(keys) >> np.uint64(11)).astype(np.float64) / 2.0**53
    order = np.argsort(c, kind="stable")
    sizes, starts = np.unique(c[order], return_index=True)
    for size, a, b in zip(sizes, starts, [*starts[1:], len(c)]):
        if size < 2:
            continue
        t, steps = np.arange(1, size), stirling_steps(discount)[size, 1:size]
        for at in np.array_split(order[a:b], max(1, (b - a) * int(size) >> 20)):
            # clipped far above what any corpus reaches, so that no product overflows
            more = np.minimum(parent[at][:, None] * (strength[at][:, None] + discount * t) * steps, 1e9)
            upto = 1 + np.cumsum(np.cumprod(more, axis=1), axis=1)
            bar = uniform[at] * upto[:, -1]
            out[at] = 1 + (bar >= 1) + (upto[:, :-1] < bar[:, None]).sum(axis=1)
    return out


def packed(values: np.ndarray) -> bytes:
    """Compressed bytes of numbers, those of equal weight together: sorted and small numbers share many."""
    values = np.ascontiguousarray(values)
    return _SHRINK.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes | None, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_EXPAND.decompress(data) if data else b"", dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Compressed bytes of keys in ascending order, each as what it is above the one before."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes | None) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def _counted(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts, most of them one, as a bit for those and the other numbers."""
    one = counts == 1
    return np.packbits(one).tobytes(), packed(counts[~one].astype(np.int64))


def _uncounted(ones: bytes, rest: bytes, n: int) -> np.ndarray:
    one = np.unpackbits(np.frombuffer(ones, dtype=np.uint8), count=n).astype(bool)
    counts = np.ones(n, dtype=np.int64)
    counts[~one] = unpacked(rest, np.int64)
    return counts


def _row(chunk: int, part: int, kind: str, *xs: bytes, stats: tuple[int, ...] = (0, 0, 0, 0)) -> tuple:
    return (chunk, part, kind, *xs, *[None] * (4 - len(xs)), *[int(s) for s in stats])


def _messages(rows: list[tuple]) -> pa.Table:
    pa.default_memory_pool().release_unused()
    kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 4, *[pa.int64()] * 4]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=_FIELDS)


def _of(table: pa.Table, kind: str) -> list[dict]:
    chosen = table.filter(pc.equal(table["kind"], kind)).to_pylist()
    return sorted(chosen, key=lambda r: (r["part"], r["chunk"]))


def _joined(rows: list[dict], column: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *[unpacked(r[column], kind) for r in rows]])


def _joined_keys(rows: list[dict]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[unpacked_keys(r["x0"]) for r in rows]])


def _cuts(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(part, begin, end) of each part of the hash range that sorted keys fall in."""
    if len(keys):
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        found, starts = np.unique(part, return_index=True)
        yield from zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)])


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """Words of a lower-cased text, some at a time."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + _SLICE) if len(data) - at > _SLICE else None
        stop = cut.start() if cut else len(data)
        yield data[at:stop].split()
        at = stop + 1


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a batch that go to one chunk as one row, their lower-cased texts compressed together."""
    shrink = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        order = np.argsort(batch.column(3).to_numpy(), kind="stable")
        chunk = batch.column(3).to_numpy()[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(chunk)) + 1, [len(chunk)])) if len(chunk) else [0]
        names, learn, sizes, blobs = [], [], [], []
        for a, b in zip(cuts, cuts[1:]):
            at = pa.array(order[a:b])
            texts = [(t or "").encode().lower() for t in batch.column(1).take(at).to_pylist()]
            names.append(batch.column(0).take(at).to_pylist())
            learn.append(batch.column(2).take(at).to_pylist())
            sizes.append([len(t) for t in texts])
            blobs.append(shrink.compress(b"".join(texts)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk[cuts[:-1]], pa.int32()), pa.array(names, pa.list_(batch.column(0).type)),
             pa.array(learn, pa.list_(pa.bool_())), pa.array(sizes, pa.list_(pa.int32())), pa.array(blobs, pa.binary())],
            names=["chunk", "names", "learn", "sizes", "blob"],
        )


class Chunk:
    """Words and pairs of a chunk's documents: sorted distinct keys, and for each token the place among them."""

    def __init__(self, bundles: pa.Table, model: Model):
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        start, end = index[START], index[END]
        expand, tokens, sizes = zstandard.ZstdDecompressor(), [], []
        for lengths, blob in zip(bundles["sizes"].to_pylist(), bundles["blob"]):
            data, at = expand.decompress(blob.as_py()), 0
            for length in lengths:
                n = 1
                for ws in words_of(data[at : at + length]):
                    tokens.append(np.fromiter(map(index.__getitem__, ws), dtype=np.int32, count=len(ws)))
                    n += len(ws)
                tokens.append(np.array([end], dtype=np.int32))
                sizes.append(n)
                at += length
        token = np.concatenate(tokens)
        del tokens
        self.sizes = np.array(sizes, dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        before = np.concatenate((np.array([start], dtype=np.int32), token[:-1]))
        before[self.ends[:-1]] = start
        learn = np.array([x for some in bundles["learn"].to_pylist() for x in some], dtype=bool)
        self.doc_learn, self.learn, self.n_learn = learn, np.repeat(learn, self.sizes), int(learn.sum())
        digest = xxhash.xxh64_intdigest
        keys = np.fromiter((digest(w) for w in index), dtype=np.uint64, count=len(index))
        del index
        order = np.argsort(keys)
        place = np.empty(len(keys), dtype=np.int32)
        place[order] = np.arange(len(keys), dtype=np.int32)
        self.words, self.word, self.before = keys[order], place[token], place[before]
        self.key = _paired(_mixed(keys)[before], keys[token], model.key_bits)

    def with_pairs(self) -> Chunk:
        self.pairs, pair = np.unique(self.key, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del self.key
        return self

    def word_counts(self) -> np.ndarray:
        counts = np.bincount(self.word[self.learn], minlength=len(self.words))
        counts[np.searchsorted(self.words, START_KEY)] = self.n_learn
        return counts

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pair keys and how often each is learned here."""
        marked = np.sort(self.key | self.learn.astype(np.uint64))  # the lowest bit of a key is free
        del self.key
        keys = marked & ~np.uint64(1)
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[starts], np.add.reduceat((marked & np.uint64(1)).astype(np.int64), starts)


def _ask(model: Model):
    """A chunk's questions: its words ('w') and pairs ('p') by part, with its own counts of learned ones."""

    def run(bundles: pa.Table) -> pa.Table:
        chunk, number = Chunk(bundles, model), bundles["chunk"][0].as_py()
        rows = []
        for kind, keys, counts in (("w", chunk.words, chunk.word_counts()), ("p", *chunk.pair_counts())):
            for part, a, b in _cuts(keys, model.bits):
                rows.append(_row(number, part, kind, packed_keys(keys[a:b]), *_counted(counts[a:b])))
        return _messages(rows)

    return run


def _total(asked: pa.Table) -> pa.Table:
    """Answers of one part: counts over all chunks, and a bit in the first chunk that learned the key.

    Statistics: distinct keys, keys counted once and twice, and the sum; the start mark is no word.
    """
    rows = sorted(asked.to_pylist(), key=lambda r: r["chunk"])
    each = [unpacked_keys(r["x0"]) for r in rows]
    sizes, keys = [len(x) for x in each], np.concatenate(each)
    own = np.concatenate([_uncounted(r["x1"], r["x2"], n) for r, n in zip(rows, sizes)])
    found, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, weights=own, minlength=len(found)).astype(np.int64)
    learned = np.flatnonzero(own > 0)[::-1]
    earliest = np.full(len(found), -1, dtype=np.int64)
    earliest[at[learned]] = learned  # the last assignment, of the first chunk, stays
    first = np.zeros(len(keys), dtype=bool)
    first[earliest[earliest >= 0]] = True
    counted = total[(found != START_KEY) & (total > 0)] if rows[0]["kind"] == "w" else total[total > 0]
    stats = (len(counted), (counted == 1).sum(), (counted == 2).sum(), counted.sum())
    answer, ends = total[at], np.cumsum(sizes)
    return _messages([
        _row(
            r["chunk"], r["part"], r["kind"], *_counted(answer[e - n : e]), np.packbits(first[e - n : e]).tobytes(),
            packed(np.array([n], dtype=np.int64)), stats=stats if i == 0 else (0, 0, 0, 0),
        )
        for i, (r, n, e) in enumerate(zip(rows, sizes, ends))
    ])


def _totals(answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and first-seen bits of a chunk's keys, parts end to end."""
    sizes = [int(unpacked(r["x3"], np.int64)[0]) for r in answers]
    counts = [_uncounted(r["x0"], r["x1"], n) for r, n in zip(answers, sizes)]
    first = [np.unpackbits(np.frombuffer(r["x2"], dtype=np.uint8), count=n).astype(bool) for r, n in zip(answers, sizes)]
    return np.concatenate(counts), np.concatenate(first)


def _settle(model: Model):
    """What a chunk keeps once counts are known.

    'words' by part: keys, pairs seen first here that end with the word, that begin with it, counts.
    'asks' by part: keys of the words of 'cells', the pairs seen first here with two customers or more.
    'pairs': counts of all pairs. Statistics of words and pairs are passed on in 'ws' and 'ps'.
    'places': each token's word, as its rank by frequency here, which compresses to about a byte, so that scoring
    reads no text again; the words by rank, and the documents.
    """

    def run(bundles: pa.Table, answers: pa.Table) -> pa.Table:
        number, rows = answers["chunk"][0].as_py(), []
        got = {kind: _of(answers, kind) for kind in ("w", "p")}
        for kind, some in got.items():
            rows.append(_row(number, -1, kind + "s", stats=tuple(sum(r[f"s{k}"] for r in some) for k in range(4))))
        chunk = Chunk(bundles, model).with_pairs()
        count, _ = _totals(got["w"])
        pair_count, first = _totals(got["p"])
        u, w = np.zeros(len(chunk.pairs), dtype=np.int32), np.zeros(len(chunk.pairs), dtype=np.int32)
        u[chunk.pair], w[chunk.pair] = chunk.before, chunk.word
        ending = np.bincount(w[first], minlength=len(count)).astype(np.int32)
        beginning = np.bincount(u[first], minlength=len(count)).astype(np.int32)
        for part, a, b in _cuts(chunk.words, model.bits):
            columns = (ending[a:b], beginning[a:b], count[a:b])
            rows.append(_row(number, part, "words", packed_keys(chunk.words[a:b]), *map(packed, columns)))
        shared = first & (pair_count > 1)
        named, place = np.unique(np.concatenate((u[shared], w[shared])), return_inverse=True)
        place, n = place.astype(np.int32), int(shared.sum())
        rows.append(_row(number, -1, "cells", packed(place[:n]), packed(place[n:]), packed(pair_count[shared])))
        for part, a, b in _cuts(chunk.words[named], model.bits):
            rows.append(_row(number, part, "asks", packed_keys(chunk.words[named][a:b])))
        rows.append(_row(number, -1, "pairs", *_counted(pair_count)))
        learn = np.packbits(chunk.doc_learn).tobytes()
        frequent = np.argsort(-np.bincount(chunk.word, minlength=len(chunk.words)), kind="stable").astype(np.int32)
        rank = np.empty_like(frequent)
        rank[frequent] = np.arange(len(frequent), dtype=np.int32)
        rows.append(_row(number, -1, "places", packed(rank[chunk.word]), packed(frequent), packed(chunk.sizes), learn))
        names = [x for some in bundles["names"].to_pylist() for x in some]
        named = pa.array([None] * (len(rows) - 1) + [names], bundles["names"].type)
        return _messages(rows).append_column("names", named)

    return run


def _open(rows: pa.Table) -> pa.Table:
    """State of one part before the first round: every pair has one table, every word of the root too.

    'at' by chunk: where its words stand among the keys of the state, which stay the same in all rounds.
    """
    words = _of(rows, "words")
    each = [unpacked_keys(r["x0"]) for r in words]
    keys, at = np.unique(np.concatenate(each), return_inverse=True)
    m, u = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    np.add.at(m, at, _joined(words, "x1", np.int32))
    np.add.at(u, at, _joined(words, "x2", np.int32))
    known = (m > 0) | (u > 0)
    keys, m, u = keys[known], m[known], u[known]
    places = [
        _row(r["chunk"], r["part"], "at", *_placed(*_found(keys, mine))) for r, mine in zip(words, each)
    ]
    return pa.concat_tables([_state(words[0]["part"], "state", keys, m, np.minimum(m, 1), u), _messages(places)])


def _state(part: int, kind: str, keys, m, t, u) -> pa.Table:
    stats = (m.sum(), t.sum(), (m == 1).sum(), (m == 2).sum())
    return _messages([_row(-1, part, kind, packed_keys(keys), packed(m), packed(t), packed(u), stats=stats)])


def _found(keys: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``mine`` stand or would stand among ``keys``, both ascending, and which of them are there."""
    at = np.searchsorted(keys, mine)
    return at, (at < len(keys)) & (np.append(keys, np.uint64(0))[at] == mine)


def _placed(at: np.ndarray, there: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending places as steps, most of them of one byte, and a bit for each that is taken."""
    return packed(np.diff(at, prepend=0).astype(np.int32)), np.packbits(there).tobytes()


def _unplaced(steps: bytes, there: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.cumsum(unpacked(steps, np.int32), dtype=np.int64)
    return at, np.unpackbits(np.frombuffer(there, dtype=np.uint8), count=len(at)).astype(bool)


def _looked_up(asked: pa.Table, state: pa.Table, of: str, kind: str) -> list[tuple]:
    """For each chunk's keys, or places of keys: customers, root tables and own tables; zero where never learned."""
    (now,) = _of(state, of) or [None]
    if now is None:
        return []
    keys = unpacked_keys(now["x0"])
    columns = [np.concatenate((unpacked(now[x], np.int64), [0])) for x in ("x1", "x2", "x3")]
    rows = []
    for r in sorted(asked.to_pylist(), key=lambda r: r["chunk"]):
        at, there = _unplaced(r["x0"], r["x1"]) if r["kind"] == "at" else _found(keys, unpacked_keys(r["x0"]))
        at = np.where(there, at, len(keys))
        rows.append(_row(r["chunk"], r["part"], kind, *[packed(c[at]) for c in columns]))
    return rows


def _seat(model: Model, nth: int):
    """A chunk redraws the tables of its cells given the round before, and reports tables beyond the first."""

    def run(kept: pa.Table, answers: pa.Table) -> pa.Table:
        cells, asks = _of(kept, "cells"), _of(kept, "asks")
        if not asks:
            return _messages([])
        keys = _joined_keys(asks)
        got = _of(answers, "answer")
        m, t, u = (_joined(got, x, np.int64) for x in ("x0", "x1", "x2"))
        before, word = unpacked(cells[0]["x0"], np.int32), unpacked(cells[0]["x1"], np.int32)
        c = unpacked(cells[0]["x2"], np.int64)
        drawn = model.draw(pair_keys(keys[before], keys[word], model.key_bits), c, model.root(m, t, nth - 1)[word], u[before], nth) - 1
        more = [np.bincount(at, drawn, minlength=len(keys)).astype(np.int64) for at in (word, before)]
        number = cells[0]["chunk"]
        return _messages([
            _row(number, part, "more", packed_keys(keys[a:b]), packed(more[0][a:b]), packed(more[1][a:b]))
            for part, a, b in _cuts(keys, model.bits)
        ])

    return run


def _reseat(model: Model, nth: int):
    """A part takes in the new tables, redraws its words' tables at the root and answers who asked."""

    def run(more: pa.Table, opened: pa.Table) -> pa.Table:
        first = _of(opened, "state")
        if not first:
            return _messages([])
        keys = unpacked_keys(first[0]["x0"])
        m, u = (unpacked(first[0][x], np.int64).copy() for x in ("x1", "x3"))
        rows = _of(more, "more")
        at = np.searchsorted(keys, _joined_keys(rows))
        np.add.at(m, at, _joined(rows, "x1", np.int64))
        np.add.at(u, at, _joined(rows, "x2", np.int64))
        base = np.full(len(m), 1.0 / (model.distinct + 1))
        strength = np.full(len(m), model.strength + model.root_discount * max(model.tables[nth - 1] - 1, 0))
        t = tables(keys + np.uint64(nth), m, base, strength, model.root_discount)
        state = _state(first[0]["part"], "state", keys, m, t, u)
        answers = _messages(_looked_up(more, state, "state", "answer"))
        return pa.concat_tables([state, answers])

    return run


def _answer(kinds: dict[str, str]):
    """Answers from the states of each kind, under the name it maps to."""

    def run(asked: pa.Table, states: pa.Table) -> pa.Table:
        return _messages([row for of, kind in kinds.items() for row in _looked_up(asked, states, of, kind)])

    return run


def _score(model: Model, key: str, burn: int):
    """Scores of a chunk's documents: log10 of the predictive probabilities averaged over the kept rounds."""
    rounds = len(model.tables) - 1

    def run(kept: pa.Table) -> pa.Table:
        of_words, (some,) = _of(kept, "words"), _of(kept, "pairs")
        words, count = _joined_keys(of_words), _joined(of_words, "x3", np.int64)
        places = kept.filter(pc.equal(kept["kind"], "places"))
        rank, frequent = (unpacked(places[x][0].as_py(), np.int32) for x in ("x0", "x1"))
        word = frequent[rank]
        sizes = unpacked(places["x2"][0].as_py(), np.int64)
        names = places["names"].combine_chunks().flatten()
        learn = np.unpackbits(np.frombuffer(places["x3"][0].as_py(), np.uint8), count=len(names)).astype(bool)
        ends = np.cumsum(sizes)
        start = np.searchsorted(words, START_KEY)
        before = np.concatenate((np.array([start], dtype=np.int32), word[:-1]))
        before[ends[:-1]] = start
        keys, pair = np.unique(_paired(_mixed(words)[before], words[word], model.key_bits), return_inverse=True)
        pair = pair.astype(np.int32)
        c = _uncounted(some["x0"], some["x1"], len(keys))
        u, w = np.zeros(len(keys), dtype=np.int32), np.zeros(len(keys), dtype=np.int32)
        u[pair], w[pair] = before, word
        del before, rank

        def state(r: int) -> list[np.ndarray]:
            rows = _of(kept, f"answer{r}")
            found = [_joined(rows, x, np.int64) for x in ("x0", "x1", "x2")]
            return [x if len(x) else np.zeros(len(count), dtype=np.int64) for x in found]

        total, (m0, t0, u0) = np.zeros(len(c)), state(burn)
        for r in range(burn + 1, rounds + 1):
            m, t, tables_of = state(r)
            drawn = np.minimum(c, 1)
            many = c > 1
            drawn[many] = model.draw(keys[many], c[many], model.root(m0, t0, r - 1)[w[many]], u0[u[many]], r)
            customers = model.strength + count[u]
            spare = (model.strength + model.discount * tables_of[u]) / customers
            spare = np.where(count[u] > 0, spare, 1.0)
            total += np.maximum(c - model.discount * drawn, 0) / customers + spare * model.root(m, t, r)[w]
            m0, t0, u0 = m, t, tables_of
        by_pair = np.log10(total / max(1, rounds - burn))
        count[start] = 0
        by_word = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        starts = ends - sizes
        add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every document has a token
        return pa.table(
            [names, pa.array(~learn), pa.array(sizes), pa.array(add((count > 0).astype(np.int64)[word])),
             pa.array(np.full(len(starts), model.tokens, dtype=np.int64)),
             pa.array(np.round(add(by_word[word]), 6)), pa.array(np.round(add(by_pair[pair]), 6))],
            names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def _stats(rows: DataFrame, kind: str) -> list[int]:
    found = rows.filter(F.col("kind") == kind).agg(*[F.sum(f"s{k}") for k in range(4)]).first()
    return [int(x or 0) for x in found]


def _release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps now, which it does once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def log_likelihood(
    docs: DataFrame, key: str = "doc_id", held_out: int = 1, rounds: int = 3, burn: int = 1, strength: float = 1.0,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row of ``docs``.

    Learns from rows whose crc32 remainder is not ``held_out`` and scores all. In each of ``rounds`` Gibbs
    rounds all restaurants are redrawn given the parent, then the parent given them; tables of other dishes
    are those of the round before, as every restaurant is drawn at once. Predictive probabilities are averaged
    over the rounds after ``burn``. Discounts are estimated from how many pairs (for the root: words) have one
    and two customers. A word never learned has the root's spare probability times the uniform base's.

    NULL and blank text is the end token alone; a NULL key has remainder 0. Repeated rows count and score each.
    Without learned rows every word has the base probability. An empty table gives an empty result. The number
    of chunks and of parts follows the bytes of text; a chunk needs memory for its texts, or one longer text.
    """
    if not 0 <= burn < rounds:
        raise ValueError("at least one round must follow the burn-in")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(LEAST_CHUNKS, math.ceil(size / chunk_bytes))
    key_bytes = math.ceil((SPARE_BITS + math.ceil(math.log2(size + 1))) / 8)
    model = Model(
        bits=max(6, math.ceil(math.log2(chunks)) - 1), key_bits=8 * min(7, max(5, key_bytes)), strength=strength
    )
    kind = key_type(docs, key)

    dealt = docs.select(
        key, "text", (remainder(key) != held_out).alias("learn"), (spread(key, "text") % chunks).cast("int").alias("chunk")
    )
    bundles = dealt.mapInArrow(
        _bundle, f"chunk int, names array<{kind}>, learn array<boolean>, sizes array<int>, blob binary"
    ).groupBy("chunk")
    answers = (
        bundles.applyInArrow(_ask(model), MESSAGE).groupBy("part", "kind").applyInArrow(_total, MESSAGE)
    )
    settled = bundles.cogroup(answers.groupBy("chunk")).applyInArrow(_settle(model), f"{MESSAGE}, names array<{kind}>")
    kept = saved(settled)
    del bundles, answers, settled
    distinct, _, _, tokens = _stats(kept, "ws")
    _, once, twice, _ = _stats(kept, "ps")
    # only now: Spark's listeners hold the plan of a write until later jobs have come to them
    _release(docs.sparkSession)
    model = replace(model, tokens=tokens, distinct=distinct, discount=_discount(once, twice))

    def by(kinds: str | list[str]) -> DataFrame:
        return kept.filter(F.col("kind").isin(kinds)).drop("names")

    def state(table: DataFrame) -> DataFrame:
        return table.filter("kind = 'state'")

    opened = saved(by("words").groupBy("part").applyInArrow(_open, MESSAGE))
    customers, root_tables, once, twice = _stats(opened, "state")
    model = replace(
        model, root_discount=_discount(once, twice), customers=(customers,), tables=(root_tables,)
    )
    asked, opened = opened.filter("kind = 'at'"), state(opened)
    answered = by("asks").groupBy("part").cogroup(opened.groupBy("part")).applyInArrow(
        _answer({"state": "answer"}), MESSAGE
    )
    states = [opened]
    for nth in range(1, rounds + 1):
        more = (
            by(["asks", "cells"]).groupBy("chunk").cogroup(answered.groupBy("chunk"))
            .applyInArrow(_seat(model, nth), MESSAGE)
        )
        table = saved(more.groupBy("part").cogroup(opened.groupBy("part")).applyInArrow(_reseat(model, nth), MESSAGE))
        customers, root_tables, _, _ = _stats(table, "state")
        model = replace(model, customers=(*model.customers, customers), tables=(*model.tables, root_tables))
        states.append(state(table))
        answered = table.filter("kind = 'answer'")
        _release(docs.sparkSession)
    past = functools.reduce(DataFrame.unionByName, [
        states[nth].withColumn("kind", F.lit(f"state{nth}")) for nth in range(burn, rounds + 1)
    ])
    found = asked.groupBy("part").cogroup(past.groupBy("part")).applyInArrow(
        _answer({f"state{nth}": f"answer{nth}" for nth in range(burn, rounds + 1)}), MESSAGE
    )
    known = kept.filter(F.col("kind").isin("words", "pairs", "places")).withColumns(
        {x: F.when(F.col("kind") != "words", F.col(x)).alias(x) for x in ("x1", "x2")}
    )
    schema = (
        f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    scored = known.unionByName(found, allowMissingColumns=True).groupBy("chunk").applyInArrow(_score(model, key, burn), schema)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
