"""Hard negatives by threshold joins: an inverted index that leaves out what norms cover, thresholds lowered until full."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved, spread
from ledgerloom.llm.multi_index import finite, matrix

# Whole numbers a component becomes, rows indexed by one task, anchors joined together, dimensions of one list.
SCALE = 256
SHARD_ROWS = 16384
TOGETHER = 128
LIST_DIMS = 8
# Rows that first thresholds are estimated from, rows above a threshold aimed at for each wanted, and how many
# standard deviations a threshold is lowered before it goes altogether.
SAMPLE = 4096
AIM = 4
LOWER_BY = 0.75
# No upper bound, and no lower one. Scores lie between them.
TOP, BOTTOM = 1 << 62, -(1 << 62)


def whole(column: pa.Array, scale: int) -> np.ndarray:
    return np.floor(matrix(column) * scale)


class Lists:
    """Inverted index of some rows for scores of at least ``least`` with anchors no longer than ``reach``.

    Dimensions come in the order of their mean square, a list to each few of them. A row is left out of the last
    lists while the norm of those coordinates, times ``reach``, stays below ``least``: they cannot make a score alone,
    so every row that reaches ``least`` is met in an earlier list. A row is in no list where its coordinates are zero.
    """

    def __init__(self, ids: np.ndarray, labels: list[str], rows: np.ndarray, least: float, reach: float):
        self.ids, self.rows = ids, rows
        self.names, self.label = np.unique(np.array(labels, dtype=object).astype(str), return_inverse=True)
        order = np.argsort(-(rows * rows).mean(axis=0), kind="stable")
        self.dims = [order[i : i + LIST_DIMS] for i in range(0, len(order), LIST_DIMS)]
        self.left = self._left(rows)
        self.upto = (self.left[:, :-1] * reach >= least).sum(axis=1)  # how many lists a row may be in
        self.lists = []
        for at, dims in enumerate(self.dims):
            chosen = np.flatnonzero((at < self.upto) & (rows[:, dims] != 0).any(axis=1))
            self.lists.append((chosen, rows[np.ix_(chosen, dims)]))

    def _left(self, x: np.ndarray) -> np.ndarray:
        """Norm of the coordinates of each list and all after it; 0 after the last."""
        squares = np.stack([(x[:, d] ** 2).sum(axis=1) for d in self.dims] + [np.zeros(len(x))], axis=1)
        return np.sqrt(squares[:, ::-1].cumsum(axis=1)[:, ::-1])

    def reached(self, ids: np.ndarray, names: list[str], anchors: np.ndarray, least: np.ndarray, same: bool):
        """(anchor, row, score) of every pair of like (or unlike) label whose score is at least the anchor's ``least``.

        Partial scores are summed list by list. A pair is dropped as soon as its partial score and the norms of what
        is left (or left out) cannot reach the threshold; scores are whole, so half a point covers rounding.
        """
        left, bar = self._left(anchors), least - 0.5
        number = {name: i for i, name in enumerate(self.names.tolist())}
        mine = np.array([number.get(n, -1) for n in names])
        alive = (mine[:, None] == self.label) == same
        alive &= ids[:, None] != self.ids
        score = np.zeros(alive.shape)
        a = row = None
        for at, (chosen, values) in enumerate(self.lists):
            seen = np.minimum(at + 1, self.upto)
            rest = self.left[np.arange(len(seen)), seen]
            if a is None:
                score[:, chosen] += anchors[:, self.dims[at]] @ values.T
                alive &= score + left[:, seen] * rest >= bar[:, None]
                if np.count_nonzero(alive) < alive.size // 8:  # few enough to go on pair by pair
                    a, row = np.nonzero(alive)
                    score = score[a, row]
                continue
            listed = np.flatnonzero(at < self.upto[row])
            for i in range(0, len(listed), 65536):
                some = listed[i : i + 65536]
                score[some] += (anchors[a[some]][:, self.dims[at]] * self.rows[row[some]][:, self.dims[at]]).sum(axis=1)
            keep = score + left[a, seen[row]] * rest[row] >= bar[a]
            a, row, score = a[keep], row[keep], score[keep]
        if a is None:
            a, row = np.nonzero(alive)
        exact = np.concatenate([np.zeros(0), *[
            (anchors[a[i : i + 16384]] * self.rows[row[i : i + 16384]]).sum(axis=1) for i in range(0, len(a), 16384)
        ]])
        keep = exact >= least[a]
        return a[keep], row[keep], exact[keep].astype(np.int64)


_FOUND = "anchor_id bigint, top bigint, ids array<bigint>, scores array<bigint>"


def _joined(least: float, reach: float, wanted: int, same: bool, scale: int):
    """Reads groups sorted with rows before anchors; the best ``wanted`` rows of each anchor's windows."""

    def windows(lists: Lists, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(some), TOGETHER):
            part = some.slice(i, TOGETHER)
            ids, names = part.column("id").to_numpy(), part.column("label").to_pylist()
            tops, lows = part.column("tops").to_pylist(), part.column("lows").to_pylist()
            bars = np.array([min(x) for x in lows], dtype=np.float64)
            a, row, score = lists.reached(ids, names, whole(part.column("vec"), scale), bars, same)
            order = np.lexsort((lists.ids[row], -score, a))
            a, row, score = a[order], row[order], score[order]
            cuts = np.searchsorted(a, np.arange(len(part) + 1))
            found = []
            for n, (first, last) in enumerate(zip(cuts[:-1], cuts[1:])):
                falling = -score[first:last]
                for top, low in zip(tops[n], lows[n]):
                    begin = first + np.searchsorted(falling, -top, side="left")
                    end = min(begin + wanted, first + np.searchsorted(falling, -low, side="right"))
                    if begin < end:
                        found.append((int(ids[n]), top, lists.ids[row[begin:end]], score[begin:end]))
            if found:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "top", "ids", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, lists = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "part", "anchor")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                *group, anchor = key[a].tolist()
                if group != at:
                    at, rows, lists = group, [], None
                if not anchor:
                    rows.append(batch.slice(a, b - a))
                elif rows or lists:
                    if lists is None:
                        ids = np.concatenate([r.column("id").to_numpy() for r in rows])
                        labels = [x for r in rows for x in r.column("label").to_pylist()]
                        vectors = np.concatenate([whole(r.column("vec"), scale) for r in rows])
                        lists, rows = Lists(ids, labels, vectors, least, reach), []
                    yield from windows(lists, batch.slice(a, b - a))

    return run


def _estimated(labels: list[str], sample: np.ndarray, wanted: int, scale: int):
    """First threshold of an anchor: where about ``AIM`` times the wanted rows of its label should lie above."""
    same = np.array(labels, dtype=object).astype(str)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = whole(batch.column("vec"), scale) @ sample.T if len(batch) else np.zeros((0, len(sample)))
            first, by = [], []
            for own, label, n in zip(scores, batch.column("label").to_pylist(), batch.column("n").to_pylist()):
                like = own[same == label]
                like = like if len(like) >= 8 else own
                above = AIM * wanted / n
                first.append(math.floor(like.mean() + like.std() * NormalDist().inv_cdf(1 - above)) if above < 0.5 else BOTTOM)
                by.append(max(1, math.ceil(LOWER_BY * like.std())))
            columns = [*(batch.column(c) for c in ("id", "label", "vec")), pa.array(first, pa.int64()), pa.array(by, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vec", "low", "by"])

    return run


class _Join:
    """Rows dealt to shards by label, and the rounds that join anchors with them."""

    def __init__(self, rows: DataFrame, wanted: int, scale: int):
        self.wanted, self.scale = wanted, scale
        self.buckets = max(1, math.ceil(rows.count() / SHARD_ROWS))
        dealt = rows.withColumn("bucket", self.bucket())
        self.sizes = saved(
            dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
            .select("bucket", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("parts"))
        )
        self.rows = dealt.join(self.sizes, "bucket").withColumn("part", (spread("id", "vec") % F.col("parts")).cast("int"))

    def bucket(self) -> Column:
        return (spread("label") % self.buckets).cast("int")

    def _norm(self) -> Column:
        square = lambda s, x: s + F.pow(F.floor(x.cast("double") * self.scale), F.lit(2.0))
        return F.aggregate("vec", F.lit(0.0), square, F.sqrt)

    def found(self, anchors: DataFrame, same: bool) -> DataFrame:
        """(anchor_id, top, id, score, rank): the best rows of each window of ``anchors`` (id, label, vec, tops, lows)."""
        least, reach = anchors.agg(F.min(F.array_min("lows")), F.max(self._norm())).first()
        columns = ("bucket", "part", "anchor", "id", "label", "vec", "tops", "lows")
        none = F.lit(None).cast("array<bigint>")
        kept = self.rows.withColumns({"anchor": F.lit(0), "tops": none, "lows": none})
        at = self.bucket() if same else F.explode(F.sequence(F.lit(0), F.lit(self.buckets - 1)))
        sent = anchors.withColumn("bucket", at).join(self.sizes, "bucket").withColumns(
            {"anchor": F.lit(1), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))}
        )
        dealt = kept.select(*columns).unionByName(sent.select(*columns))
        ordered = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "anchor")
        pairs = ordered.mapInArrow(_joined(float(least), float(reach), self.wanted, same, self.scale), _FOUND)
        each = pairs.select("anchor_id", "top", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))))
        order = Window.partitionBy("anchor_id", "top").orderBy(F.desc("score"), "id")
        return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.wanted)


def _positives(join: _Join, anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """(anchor_id, top, id, score, rank) of each anchor's best rows of its label."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    at = spread("id", "vec")
    total = rows.count()
    few = rows.filter((at % 1_000_003) / 1_000_003.0 < min(1.0, 1.5 * SAMPLE / max(1, total) + 1e-9)).orderBy(at, "id").limit(SAMPLE)
    drawn = few.select("label", "vec").toArrow()
    sample = whole(drawn["vec"].combine_chunks(), join.scale)
    kind = rows.schema["vec"].dataType.simpleString()
    first = _estimated(drawn["label"].to_pylist(), sample, join.wanted, join.scale)
    open_ = saved(
        anchors.join(counts, "label").select("id", "label", "vec", "n")
        .mapInArrow(first, f"id bigint, label string, vec {kind}, low bigint, by bigint")
    )
    done, lowered = [], 0
    while not open_.isEmpty():
        windows = open_.withColumns({"tops": F.array(F.lit(TOP)), "lows": F.array("low")})
        found = saved(join.found(windows, same=True))
        full = found.filter(F.col("rank") == join.wanted).select(F.col("anchor_id").alias("id"))
        settled = full.unionByName(open_.filter(F.col("low") == BOTTOM).select("id"))
        done.append(found.join(settled.withColumnRenamed("id", "anchor_id"), "anchor_id", "left_semi"))
        lowered += 1
        low = F.col("low") - F.col("by") if lowered == 1 else F.lit(BOTTOM)
        open_ = saved(open_.join(settled, "id", "left_anti").withColumn("low", low.cast("bigint")))
    none = anchors.filter("false").select(
        F.col("id").alias("anchor_id"), F.lit(0).cast("bigint").alias("top"), "id", F.lit(0).cast("bigint").alias("score"), F.lit(0).alias("rank")
    )
    for part in done:
        none = none.unionByName(part)
    return none


def _negatives(join: _Join, anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """(anchor_id, top, id, score, rank) of each window's best rows of other labels.

    ``windows`` has each anchor's (top, low), ``low`` the last threshold; the first lies halfway, so that a window that
    fills in its upper half is done.
    """
    done, halfway, open_ = [], True, saved(windows)
    while not open_.isEmpty():
        bar = F.col("low") + F.floor((F.col("top") - F.col("low")) / 2) if halfway else F.col("low")
        at = open_.withColumn("bar", bar.cast("bigint"))
        lists = at.groupBy("anchor_id").agg(F.collect_list("top").alias("tops"), F.collect_list("bar").alias("lows"))
        found = saved(join.found(anchors.join(lists.withColumnRenamed("anchor_id", "id"), "id"), same=False))
        full = found.filter(F.col("rank") == join.wanted).select("anchor_id", "top")
        settled = full.unionByName(at.filter(F.col("bar") == F.col("low")).select("anchor_id", "top")).distinct()
        done.append(found.join(settled, ["anchor_id", "top"], "left_semi"))
        open_ = saved(open_.join(settled, ["anchor_id", "top"], "left_anti"))
        halfway = False
    none = windows.filter("false").select(
        "anchor_id", "top", F.col("top").alias("id"), F.col("top").alias("score"), F.lit(0).alias("rank")
    )
    for part in done:
        none = none.unionByName(part)
    return none


def mine(
    vectors: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vec: str = "embedding",
    wanted: int = 5, low: int = 80, high: int = 100, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    Components become floor(scale * component); a score is the whole inner product. An anchor's positives are its
    ``wanted`` best other rows of its label; each positive's negatives are the ``wanted`` best rows of other labels whose
    score is between ``low`` and ``high`` per cent of the positive's. Ties go to the smaller key. The join is exact:
    a threshold starts where enough rows are expected above it and is lowered, for the windows that are not full yet,
    until they are or nothing is left below; only what a threshold allows is scored in full.

    Rows are dealt to shards by label, large labels to several, each shard one task's inverted index. Anchors go to
    their label's shards for positives and to all for negatives, and pass by a task's index one batch at a time. What
    comes back is at most ``wanted`` rows for an anchor's window and shard.

    Rows with a NULL key, label or vector, an empty vector, or a NULL or non-finite component take no part, nor do
    vectors of another length than most. Rows that repeat an anchor's key are no candidates of it; of anchors with one
    key, the smallest label and vector counts; other rows that repeat a key are candidates each. Zero vectors take part.
    Products of a pair must stay below 2^53 to be exact. An empty table gives an empty result.
    """
    good = vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & finite(vec)).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vec).alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("_anchor"),
    )
    lengths = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = good.filter(F.size("vec") == (lengths.n if lengths else 0))
    anchors = saved(
        rows.filter("_anchor").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")
    )
    rows = rows.drop("_anchor")
    join = _Join(rows, wanted, scale)
    positives = saved(_positives(join, anchors, rows))
    least = F.ceil(F.col("score") * low / F.lit(100)).cast("bigint")
    most = F.floor(F.col("score") * high / F.lit(100)).cast("bigint")
    bounds = positives.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), most.alias("top"), least.alias("low"))
    windows = bounds.filter("low <= top").groupBy("anchor_id", "top").agg(F.min("low").alias("low"))
    negatives = _negatives(join, anchors, windows)
    return (
        bounds.filter("low <= top").join(negatives.withColumnRenamed("id", "negative_id"), ["anchor_id", "top"])
        .filter(F.col("score") >= F.col("low"))
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
    )
