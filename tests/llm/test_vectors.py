"""Nearest neighbours and hard negatives against brute force."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives, multi_index

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def vectors(n=900, dim=24, seed=1, norms=False):
    """Random directions, some crowds of near copies, exact copies of one vector; float32 as stored."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    crowd = min(60, n // 4)
    x[n // 2 : n // 2 + crowd] = x[3] + 0.05 * rng.standard_normal((crowd, dim))
    x[n - min(40, n // 8) :] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.uniform(0.2, 3.0, (n, 1))
    return [(i, [float(v) for v in np.float32(row)], int(rng.integers(0, 4))) for i, row in enumerate(x)]


ODD = [
    (5000, None, 1), (5020, [0.0] * 24, 1), (5040, [float("nan")] * 24, 1), (5060, [float("inf")] + [0.1] * 23, 1),
    (5080, [None] + [0.1] * 23, 2), (None, [0.1] * 24, 1), (5100, [0.1] * 3, 1), (5120, [], 0), (5200, [0.1] * 24, None),
]


def test_vectors_that_take_no_part_are_told_apart(spark):
    rows = spark.createDataFrame(ODD, SCHEMA)
    found = {r.vec_id for r in rows.filter(multi_index.usable("embedding")).collect()}
    assert found == {None, 5100, 5200}
    found = {r.vec_id for r in rows.filter(multi_index.finite("embedding")).collect()}
    assert found == {None, 5020, 5100, 5200}


def brute_nearest(rows, is_query, k):
    rows = [(i, np.array(v, dtype=np.float64)) for i, v, _ in rows]
    out = {}
    for q, v in rows:
        if is_query(q):
            ranked = sorted(((-(x * v).sum(), i) for i, x in rows if i != q))
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def searched(spark, rows, every, k, **more):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "vec", "code", "rank", "score")})
    got = defaultdict(list)
    for r in multi_index.nearest(table, table.filter(F.col("vec_id") % every == 0), k=k, **more).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(found)] for q, found in got.items()}


@pytest.mark.parametrize("norms", [False, True])
def test_nearest_rows_are_found_and_ordered(spark, norms):
    rows = vectors(norms=norms)
    got = searched(spark, rows + ODD, 20, 7)
    want = brute_nearest(rows + [r for r in ODD if r[0] == 5200], lambda i: i % 20 == 0, 7)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.95 * 7 * len(want)
    by_id = {i: np.array(v, dtype=np.float64) for i, v, _ in rows} | {5200: np.array(np.float32([0.1] * 24), dtype=np.float64)}
    for q, found in got.items():
        assert len(found) == 7 and q not in {i for i, _ in found}
        assert [(-s, i) for i, s in found] == sorted((-s, i) for i, s in found)
        assert all(math.isclose(s, (by_id[q] * by_id[i]).sum(), rel_tol=1e-12) for i, s in found)


def test_regions_and_parts_do_not_change_what_is_found(spark, monkeypatch):
    """Rows in many regions, a crowded one in several parts, queries a few at a time."""
    rows = vectors(700)
    at_once = searched(spark, rows, 20, 5)
    monkeypatch.setattr(multi_index, "REGION_ROWS", 40)
    monkeypatch.setattr(multi_index, "TOGETHER", 3)
    monkeypatch.setattr(multi_index, "AT_ONCE", 100)
    assert searched(spark, rows, 20, 5) == at_once


def test_every_code_within_the_radius_is_a_candidate():
    """Pigeonhole: whatever the radius, the tables together give each code within it once."""
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 63, 400, dtype=np.uint64) >> np.uint64(24)
    for radius in (0, 1, 3, 7, 10, 13, 19, 40):
        index = multi_index.Index(None, 40, 5, radius, 0, 400)
        found = np.zeros((400, 400), dtype=int)
        for j in index.tables:
            shelf = multi_index.Shelf(index, j, np.arange(400), np.zeros((400, 2)), codes)
            for q, row in shelf._candidates(codes):
                keep = shelf._within(codes[q], shelf.codes[row])
                np.add.at(found, (q[keep], shelf.ids[row[keep]]), 1)
        assert (found == (np.bitwise_count(codes[:, None] ^ codes) <= radius)).all()


def test_fewer_candidates_than_asked_for_and_short_queries(spark):
    rows = vectors(13)
    got = searched(spark, rows, 4, 20)
    want = brute_nearest(rows, lambda i: i % 4 == 0, 20)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}
    # a radius measured on none but easy neighbours leaves others short; they are searched without it
    got = searched(spark, vectors(300), 20, 9, within=0.0)
    assert {len(f) for f in got.values()} == {9}


def test_repeated_keys_and_empty_tables_of_vectors(spark):
    rows = vectors(50)
    got = searched(spark, rows + [rows[0], rows[7], (20, rows[21][1], 1)], 20, 5)
    assert set(got) == {0, 20, 40} and all(len(f) == 5 and q not in {i for i, _ in f} for q, f in got.items())
    table = spark.createDataFrame(rows, SCHEMA)
    assert multi_index.nearest(table.limit(0), table).count() == 0
    assert multi_index.nearest(table, table.limit(0)).count() == 0
    assert hard_negatives.mine(table.limit(0), F.lit(True)).count() == 0
    assert hard_negatives.mine(table, F.lit(False)).count() == 0
    one = spark.createDataFrame(rows[:1], SCHEMA)
    assert multi_index.nearest(one, one).count() == 0 and hard_negatives.mine(one, F.lit(True)).count() == 0


def brute_negatives(rows, is_anchor, wanted=5, low=80, high=100, scale=256):
    rows = [(i, [math.floor(float(np.float32(x)) * scale) for x in v], label) for i, v, label in rows]
    out = set()
    for a, v, label in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, x)), i, other) for i, x, other in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:wanted]:
            inside = [(i, -t) for t, i, other in scored if other != label and low * -s <= 100 * -t <= high * -s]
            out |= {(a, p, n, i, -s, t) for n, (i, t) in enumerate(inside[:wanted], 1)}
    return out


def mined(spark, rows, every, **more):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "vec", "low", "top", "n", "_anchor")})
    found = hard_negatives.mine(table, F.col("vec_id") % every == 0, **more)
    return [tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


@pytest.mark.parametrize("norms", [False, True])
def test_hard_negatives_equal_scoring_every_pair(spark, norms):
    rows = vectors(norms=norms)
    zero = (4000, [0.0] * 24, 2)
    got = mined(spark, rows + ODD + [zero], 20)
    want = brute_negatives(rows + [ODD[1], zero], lambda i: i % 20 == 0)  # zero vectors take part
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
    got = mined(spark, rows, 50, wanted=3, low=50, high=90)
    assert set(got) == brute_negatives(rows, lambda i: i % 50 == 0, 3, 50, 90)


def test_shards_lists_and_thresholds_do_not_change_the_negatives(spark, monkeypatch):
    """Many shards, anchors a few at a time, first thresholds far too high so that they are lowered twice."""
    rows = vectors(500)
    want = brute_negatives(rows, lambda i: i % 25 == 0)
    for name, value in (("SHARD_ROWS", 30), ("TOGETHER", 3), ("LIST_DIMS", 5), ("AIM", 1e-6), ("LOWER_BY", 0.1)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert set(mined(spark, rows, 25)) == want


def test_sparse_rows_are_left_out_of_lists_but_not_of_results():
    """Partial sums with bounds give the same pairs as full products, at every threshold."""
    rng = np.random.default_rng(9)
    rows = np.floor(256 * rng.standard_normal((300, 32)) * (rng.random((300, 32)) < 0.2) * (0.7 ** np.arange(32)))
    labels = [str(i % 3) for i in range(300)]
    anchors = rows[:40]
    full = anchors @ rows.T
    reach = np.linalg.norm(anchors, axis=1).max()
    for least in (-1e9, 0.0, 20_000.0, 80_000.0, 200_000.0):
        lists = hard_negatives.Lists(np.arange(300), labels, rows, least, reach)
        for same in (True, False):
            a, row, score = lists.reached(np.arange(40), labels[:40], anchors, np.full(40, least), same)
            ok = (np.arange(40)[:, None] % 3 == np.arange(300) % 3) == same
            ok &= (full >= least) & (np.arange(40)[:, None] != np.arange(300))
            assert set(zip(a.tolist(), row.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(ok))))
            assert (score == full[a, row]).all()
    assert sum(len(chosen) for chosen, _ in lists.lists) < 300 * len(lists.lists) / 2
