"""Changes of stored partitions, and tables bucketed by loan."""

from __future__ import annotations

import datetime as dt_
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from checks.bindings import Bindings
from ledgerloom.operators import balances, opening, payments, rewrites, spans
from ledgerloom.sources import bucketed, tables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")

ROWS = "id INT, loan_id INT, amount INT, day DATE"


def day(n):
    return dt_.date(2025, 3, 1) + dt_.timedelta(days=n)


def files(path):
    """Data files by partition."""
    found = {}
    for folder, _, names in os.walk(path):
        data = {n for n in names if n.endswith(".parquet")}
        if data:
            found[os.path.basename(folder)] = data
    return found


def untouched(before, after, days):
    """Every partition but ``days`` has the files it had."""
    changed = {k for k in before | after if before.get(k) != after.get(k)}
    return changed <= {f"day={d}" for d in days}


@pytest.fixture
def stored(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, i % 7, rng.randrange(100), day(rng.randrange(10))) for i in range(200)]
    path = str(tmp_path / "payments")
    tables.write_partitions(spark.createDataFrame(rows, ROWS), path, "day")
    return path, rows


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "loan_id", "amount", "day").collect())


def test_an_upsert_rewrites_only_the_days_it_concerns(spark, stored):
    path, rows = stored
    old = {r[0]: r for r in rows}
    held = {old[i][3] for i in (3, 4)}
    target = day(12)  # a day that is not there yet
    batch = [(3, 9, 1000, old[3][3]), (4, 9, 1001, target), (900, 9, 1002, target)]
    before = files(path)
    frame = spark.createDataFrame(batch, ROWS)
    touched = tables.upsert_stored(frame, path, "day")
    assert touched == sorted({str(d) for d in held | {target}})
    assert untouched(before, files(path), touched)
    want = sorted([r for r in rows if r[0] not in (3, 4)] + batch)
    assert content(spark, path) == want
    assert tables.upsert_stored(frame, path, "day") == sorted({str(old[3][3]), str(target)})
    assert content(spark, path) == want


def test_an_upsert_equals_the_upsert_of_the_whole_table(spark, stored):
    path, rows = stored
    rng = random.Random(8)
    batch = [(i, 1, i, day(rng.randrange(14))) for i in rng.sample(range(150, 260), 60)]
    frame = spark.createDataFrame(batch, ROWS)
    whole = spark.createDataFrame(rows, ROWS)
    want = rewrites.without_ids(whole, "id", frame).unionByName(frame)
    tables.upsert_stored(frame, path, "day")
    assert content(spark, path) == sorted(tuple(r) for r in want.collect())


def test_a_day_that_loses_all_its_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(spark.createDataFrame([(1, 1, 5, day(0)), (2, 1, 6, day(1))], ROWS), path, "day")
    moved = spark.createDataFrame([(1, 1, 5, day(1))], ROWS)
    assert tables.upsert_stored(moved, path, "day") == [str(day(0)), str(day(1))]
    assert content(spark, path) == [(1, 1, 5, day(1)), (2, 1, 6, day(1))]
    gone = spark.createDataFrame([(1,), (2,), (77,)], "id INT")
    assert tables.delete_stored(gone, path, "day") == [str(day(1))]
    assert content(spark, path) == []
    assert tables.delete_stored(gone, path, "day") == []
    assert tables.upsert_stored(moved.limit(0), path, "day") == []


def test_deletes_and_updates_leave_other_days_alone(spark, stored):
    path, rows = stored
    loans = spark.createDataFrame([(5,)], "loan_id INT")
    before = files(path)
    touched = tables.delete_stored(loans, path, "day", "loan_id")
    assert touched == sorted({str(r[3]) for r in rows if r[1] == 5}) and untouched(before, files(path), touched)
    kept = [r for r in rows if r[1] != 5]
    assert content(spark, path) == sorted(kept)
    before = files(path)
    touched = tables.update_stored(spark, path, "day", (F.col("amount") > 90) & (F.col("day") < F.lit(day(4))), {"amount": F.col("amount") * 2})
    hit = [r for r in kept if r[2] > 90 and r[3] < day(4)]
    assert touched == sorted({str(r[3]) for r in hit}) and untouched(before, files(path), touched)
    assert content(spark, path) == sorted([r for r in kept if r not in hit] + [(*r[:2], r[2] * 2, r[3]) for r in hit])
    assert tables.update_stored(spark, path, "day", F.lit(None).cast("boolean"), {"amount": F.lit(0)}) == []
    with pytest.raises(ValueError, match="partition column"):
        tables.update_stored(spark, path, "day", F.lit(True), {"day": F.lit(day(0))})


def test_only_the_touched_days_are_read(spark, stored, monkeypatch):
    path, _ = stored
    plans = []
    written = tables.write_partitions

    def watched(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, *more)

    monkeypatch.setattr(tables, "write_partitions", watched)
    tables.upsert_stored(spark.createDataFrame([(3, 1, 1, day(2))], ROWS), path, "day")
    assert re.search(r"PartitionFilters: \[[^\]]*day[^\]]*IN|PartitionFilters: \[[^\]]*day[^\]]*=", plans[0])


# -- tables bucketed by loan ------------------------------------------------------------------


@pytest.fixture(scope="module")
def by_loan(spark, tmp_path_factory):
    """Loans, payments and opening balances of the test tables in four buckets of the loan's id."""
    if not os.path.isdir(SF):
        pytest.skip("test tables not found")
    b, folder = Bindings(spark, SF), tmp_path_factory.mktemp("buckets")
    opened = opening.open_balances_policy(b.loans(), b.products_policy(), b.offers(), b.terms())
    made = {
        "bucketed_loans": (b.loans(), "id"), "bucketed_payments": (b.payments(), "loan_id"),
        "bucketed_balances": (opened, "loan_id"), "bucketed_offers": (b.offers(), "id"),
    }
    for name, (df, key) in made.items():
        bucketed.write_bucketed(df, name, str(folder / name), key, 4)
    yield b, folder
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def shuffles(df):
    """Exchanges of the plan that ran, with what lies under them; broadcasts of small tables are not shuffles."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    return [line for line in text.splitlines() if re.search(r"(?<!Broadcast)Exchange hash", line)]


def test_a_rebuild_over_bucketed_tables_shuffles_nothing(spark, by_loan):
    b, _ = by_loan
    held = bucketed.same_buckets(spark, paid="bucketed_payments", balances="bucketed_balances")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = payments.daily_totals(held["paid"], until="2025-04-01")
        got = balances.rebuild_balances(held["balances"], daily, "2025-02-15", "2025-04-01")
        assert shuffles(got) == []
        caught = balances.catch_up(held["balances"], daily, "2025-04-01")
        assert shuffles(caught) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    opened = spark.read.table("bucketed_balances")
    want = balances.rebuild_balances(opened, payments.daily_totals(b.payments(), until="2025-04-01"), "2025-02-15", "2025-04-01")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_report_over_bucketed_tables_shuffles_no_fact(spark, by_loan):
    """Loans meet their offers by the offer's key; balances and payments meet the loan without a shuffle."""
    b, _ = by_loan
    held = bucketed.same_buckets(spark, paid="bucketed_payments", balances="bucketed_balances", loans="bucketed_loans")

    def report(loans, paid, opened):
        daily = payments.daily_totals(paid)
        return spans.report_spans(
            loans, b.products_policy(), b.offers(), b.terms(), daily, balances.balance_spans(opened, daily, "2025-06-01"),
            "2025-01-01", "2025-06-01",
        )

    got = report(held["loans"], held["paid"], held["balances"])
    assert not [line for line in shuffles(got) if "loan_id" in line and "Exchange" in line and "_day" in line]
    facts = got._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    for name in ("bucketed_payments", "bucketed_balances"):
        assert f"{name}" in facts
    want = report(b.loans(), b.payments(), spark.read.table("bucketed_balances"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_bucketed_tables_open_again_and_must_agree(spark, by_loan, tmp_path):
    b, folder = by_loan
    spark.sql("DROP TABLE bucketed_payments")
    again = bucketed.open_bucketed(spark, "bucketed_payments", str(folder / "bucketed_payments"), "loan_id", 4)
    assert again.count() == b.payments().count()
    assert shuffles(again.groupBy("loan_id").count()) == []
    bucketed.write_bucketed(b.offers(), "bucketed_otherwise", str(tmp_path / "o"), "id", 3)
    with pytest.raises(ValueError, match="number of buckets"):
        bucketed.same_buckets(spark, a="bucketed_payments", b="bucketed_otherwise")
    spark.sql("DROP TABLE bucketed_otherwise")


def test_bucketed_tables_can_be_partitioned_by_day(spark, by_loan, tmp_path):
    b, _ = by_loan
    rows = b.payments().withColumn("paid_on", F.to_date("payment_dttm"))
    held = bucketed.write_bucketed(rows, "bucketed_days", str(tmp_path / "days"), "loan_id", 4, "paid_on")
    one = held.filter(F.col("paid_on") == F.lit("2025-02-03").cast("date")).groupBy("loan_id").agg(F.sum("payment_amount"))
    assert shuffles(one) == []
    assert re.search(r"PartitionFilters: \[[^\]]*paid_on", one._jdf.queryExecution().executedPlan().toString())
    spark.sql("DROP TABLE bucketed_days")
