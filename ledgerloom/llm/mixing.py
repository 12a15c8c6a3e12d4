"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations alone."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, saved

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
TEMPER = 0.95
TOLERANCE = 1e-6
SWEEPS = 50
# A sweep that leaves more than this of the gap is the last.
STALLED = 0.999
# A marginal that is further off its given target than this, as a share of it, is an error.
ALLOWED = 0.01
# Values with a smaller share of the tokens than this are raked as one class of their dimension.
LEAST_SHARE = 1e-3
REST = "(rest)"
# Share of the tokens that a sample keeps in the registered query and the pipeline.
KEEP = 0.9


def topic(text: str = "text") -> Column:
    """A coarse topic from the whole text: legal, contact, table, markup or prose."""
    t = F.lower(F.col(text))
    return (
        F.when(F.col(text).isNull(), F.lit(None))
        .when(t.contains("licen") | t.contains("rights reserved"), "legal")
        .when(t.contains("@") | t.contains("+1 ("), "contact")
        .when(t.contains(" | "), "table")
        .when(t.contains("***") | t.contains("$$$"), "markup")
        .otherwise("prose")
    )


def described(docs: DataFrame, key: str = "doc_id", carried: Sequence[str] = ()) -> DataFrame:
    """(key, source, lang, topic, tokens, _draw): what mixing needs of each document; NULL labels are a class.

    Columns named in ``carried`` come along as they are.
    """
    return docs.select(
        key, *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")],
        F.coalesce(topic(), F.lit(NONE)).alias("topic"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("tokens"),
        _draw(key).alias("_draw"), *carried,
    )


def _draw(key: str) -> Column:
    """Uniform in [0, 1) from the document itself, so that a repeated task draws the same."""
    return F.xxhash64(F.lit("mixing"), F.col(key), F.col("text")).bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """(dimension, share): natural token shares raised to ``power`` and made to sum to one."""
    totals = cells.groupBy(dimension).agg(F.sum("tokens").alias("n")).filter("n > 0")
    raised = saved(totals.select(dimension, F.pow(F.col("n").cast("double"), F.lit(power)).alias("share")))
    whole = raised.agg(F.sum("share")).first()[0] or 1.0
    return raised.select(dimension, (F.col("share") / F.lit(whole)).alias("share"))


def fit(
    cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS
) -> tuple[DataFrame, float]:
    """``cells`` with ``weight``, and the gap: how far the worst marginal is off its target, as a share of it.

    ``cells`` holds one row per combination of the dimensions with its ``tokens``; a target gives the share of
    each value of its dimension, and values without one get none. Each sweep scales one dimension after the
    other. Ends once a sweep scales by no more than ``tolerance``, or by as much as the one before because the targets
    contradict each other (a value found with one value of another dimension alone, say), or after ``sweeps``. Cells are at most the combinations that occur; sums over them combine map-side, so no dimension's largest value is one task.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    fitted = saved(cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double")))
    shares = {d: saved(t.select(d, F.col("share").alias("_share"))) for d, t in targets.items()}

    def ratios(frame: DataFrame, d: str) -> DataFrame:
        now = frame.groupBy(d).agg(F.sum("weight").alias("_now"))
        wanted = F.coalesce("_share", F.lit(0.0)) * F.lit(float(total))
        return now.join(shares[d], d, "left").select(
            d, F.when(F.col("_now") > 0, wanted / F.col("_now")).otherwise(F.lit(0.0)).alias("_ratio")
        )

    before = float("inf")
    for _ in range(sweeps if shares else 0):
        scaled = fitted.withColumn("_off", F.lit(0.0))
        for d in shares:
            moved = F.when(F.col("_ratio") > 0, F.abs(F.log("_ratio")))
            scaled = scaled.join(ratios(scaled, d), d).withColumns(
                {"weight": F.col("weight") * F.col("_ratio"), "_off": F.greatest("_off", moved)}
            ).drop("_ratio")
        scaled = saved(scaled)
        off, fitted = scaled.agg(F.max("_off")).first()[0], scaled.drop("_off")
        if off is None or off <= tolerance or off > STALLED * before:
            break
        before = off
    if not shares:
        return fitted, 0.0
    every = functools.reduce(DataFrame.unionByName, [ratios(fitted, d).select("_ratio") for d in shares])
    gap = every.filter("_ratio > 0").agg(F.max(F.abs(F.lit(1.0) - F.lit(1.0) / F.col("_ratio")))).first()[0] or 0.0
    return fitted, gap


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS,
    allowed: float = ALLOWED,
) -> DataFrame:
    """``cells`` with ``weight``: token mass of each cell once every marginal has its target share (see ``fit``).

    Targets that contradict each other, so that a marginal stays off by more than ``allowed`` of its target, are an
    error, and so is a share given to a value that no cell has.
    """
    for d, target in targets.items():
        missing = target.filter("share > 0").join(cells.filter("tokens > 0").select(d), d, "left_anti").first()
        if missing and not cells.isEmpty():
            raise ValueError(f"no tokens for the target of {d} {missing[d]}")
    fitted, gap = fit(cells, targets, tolerance, sweeps)
    if gap > allowed:
        raise ValueError(f"the targets contradict each other: a share is off by {gap:.1%} after {sweeps} sweeps")
    return fitted


def pooled(cells: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``cells`` with a column ``_<dimension>`` for each: its value, or one class for all with a small token share.

    A rare value's own target would say little and, raised in every dimension, give a few documents the weight that
    all others are measured by.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for d in DIMENSIONS:
        size = cells.groupBy(d).agg(F.sum("tokens").alias("_n"))
        name = F.when(F.col("_n") < F.lit(least_share * total), F.lit(REST)).otherwise(F.col(d))
        cells = cells.join(size.select(d, name.alias(f"_{d}")), d)
    return saved(cells)


def sampling_rate(cells: DataFrame, keep: float) -> float:
    """The rate at which min(1, rate * weight) keeps the share ``keep`` of the tokens.

    ``cells`` has tokens and weight, the factor of a cell's documents. Cells that the rate fills are counted whole and
    the rate of the others is worked out again, until no further cell is filled: a few sums over the cells.
    """
    total, free = cells.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("weight"))).first()
    if not total or keep >= 1:
        return float("inf")
    rate, full = keep * total / free, -1
    while True:
        filled = F.col("weight") * F.lit(rate) >= 1
        now, whole, free = cells.agg(
            F.count_if(filled), F.sum(F.when(filled, F.col("tokens"))),
            F.sum(F.when(~filled, F.col("tokens") * F.col("weight"))),
        ).first()
        if now == full or not free:
            return rate
        full, rate = now, (keep * total - (whole or 0)) / free


def mix(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, key: str = "doc_id", power: float = TEMPER,
    carried: Sequence[str] = (), keep: float | None = None, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(key, source, lang, topic, tokens, weight, probability, sampled, gap) for every row of ``docs``.

    ``weight`` is the factor by which the document's tokens count for all marginals to meet their targets.
    ``probability`` is min(1, rate * weight), the rate being such that the share ``keep`` of the tokens is expected in
    a sample: cells that are too small for their target are kept whole and the others share the rest in proportion.
    Without ``keep`` the rate is the largest that fills no cell but the heaviest, so that the expected tokens stand
    in the target proportions exactly, however few that leaves. ``sampled`` draws by a hash of key and text.

    Without targets each dimension's natural shares are tempered by ``power``, values below ``least_share`` of the
    tokens being one class. Such targets need not be met together; ``gap`` is how far the worst marginal of the
    weights is off, as a share of its target. Given targets that contradict each other are an error (see ``rake``).

    NULL source, lang and text are the class ``(none)``. Documents without a word have no mass: their cell's weight if
    it has one, else 1, and probability 1. Rows repeated share their fate. An empty table gives an empty result.
    Columns named in ``carried`` follow the others.
    """
    rows = described(docs, key, carried)
    cells = saved(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    names = [f"_{d}" for d in DIMENSIONS]
    classes = pooled(cells, 0.0 if targets else least_share)
    fitting = saved(
        classes.groupBy(*names).agg(F.sum("tokens").alias("tokens")).withColumnsRenamed(dict(zip(names, DIMENSIONS)))
    )
    if targets:
        fitted, gap = rake(fitting, targets), 0.0
    else:
        fitted, gap = fit(fitting, {d: tempered(fitting, d, power) for d in DIMENSIONS})
    ratios = saved(fitted.select(*DIMENSIONS, "tokens", (F.col("weight") / F.col("tokens")).alias("weight")))
    if keep is None:
        rate = 1.0 / (ratios.agg(F.max("weight")).first()[0] or 1.0)
    else:
        rate = sampling_rate(ratios, keep)
    same = functools.reduce(lambda a, b: a & b, [F.col(f"_{d}") == F.col(f"_of_{d}") for d in DIMENSIONS])
    by_class = ratios.select(*[F.col(d).alias(f"_of_{d}") for d in DIMENSIONS], F.col("weight").alias("_weight"))
    # written first, so that its size is known when it meets the documents
    named = saved(classes.join(by_class, same).select(*[F.col(d).alias(f"_is_{d}") for d in DIMENSIONS], "_weight"))
    here = functools.reduce(lambda a, b: a & b, [F.col(d) == F.col(f"_is_{d}") for d in DIMENSIONS])
    full = F.lit(1.0)
    chance = full if rate == float("inf") else F.least(F.col("_weight") * F.lit(rate), full)
    probability = F.when(F.col("tokens") == 0, full).otherwise(chance)
    return rows.join(named, here, "left").select(
        key, *DIMENSIONS, "tokens", F.coalesce("_weight", F.lit(1.0)).alias("weight"),
        probability.alias("probability"), (F.col("_draw") < probability).alias("sampled"), F.lit(gap).alias("gap"), *carried,
    )
