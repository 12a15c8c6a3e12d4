"""Spans of the report, loans caught up from their own day, and rebuilds of the loans a correction concerns."""

from __future__ import annotations

import datetime as dt_
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom import schemas
from ledgerloom.operators import accrual, balances, payments, spans
from ledgerloom.operators.partitioning import by_key
from ledgerloom.plans.daily_cycle import catch_up_day
from tests import seed_frames as seed

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")
START = dt_.date(2025, 1, 1)


def on(n):
    return START + dt_.timedelta(days=n)


def random_book(spark, seed_number, n=40, days=60, openings=30):
    """Loans opened on random days with their opening balances, and payments with refunds and overpayment."""
    rng = random.Random(seed_number)
    opened = {i: rng.randrange(0, openings) for i in range(n)}
    rows = [(i, on(d), 1000, 150, 24, 1174) for i, d in opened.items()]
    paid, k = [], 0
    for i, d in opened.items():
        for _ in range(rng.randrange(0, 9)):
            at = on(rng.randrange(0, days))
            paid.append((k, i, "s", dt_.datetime.combine(at, dt_.time(rng.randrange(24))), rng.choice([-30, 5, 100, 174, 600, 1174])))
            k += 1
    return spark.createDataFrame(rows, schemas.BALANCES), spark.createDataFrame(paid, schemas.PAYMENTS), rng


def content(df):
    return sorted(tuple(r) for r in df.select(*balances.BALANCE_COLUMNS).collect())


def stepped(history, daily, day):
    """``roll_one_day`` again and again, for the loans that are not there yet."""
    for _ in range(70):
        behind = balances.latest_open(history).filter(F.col("balance_date") < F.lit(day))
        if behind.isEmpty():
            break
        rows = balances.roll_one_day(behind, daily)
        history = history.sparkSession.createDataFrame(
            history.collect() + rows.select(*history.columns).collect(), schemas.BALANCES
        )
    return history


def test_catching_up_equals_rolling_day_after_day(spark):
    opened, paid, _ = random_book(spark, 1, 25, 9, 5)
    daily, day = payments.daily_totals(paid), on(8)
    got = opened.unionByName(balances.catch_up(opened, daily, day))
    assert content(got) == content(stepped(opened, daily, day))
    # nothing is left to do, and loans beyond the day stay as they are
    assert balances.catch_up(got, daily, day).count() == 0 and balances.catch_up(got, daily, on(6)).count() == 0
    assert content(opened.unionByName(catch_up_day(opened, paid, day))) == content(got)
    assert catch_up_day(got, paid, day).count() == 0 and catch_up_day(opened.limit(0), paid, day).count() == 0


def test_payments_before_the_oldest_newest_row_are_not_read(spark, tmp_path):
    opened, paid, _ = random_book(spark, 2)
    day = on(50)
    later = opened.unionByName(balances.catch_up(opened, payments.daily_totals(paid), on(30)))
    path = str(tmp_path / "paid")
    paid.write.parquet(path)
    rows = catch_up_day(later, spark.read.parquet(path), day)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*02-01T00:00", text)  # the day after January 31, where all stand


def spelled_out(b, held, first, last):
    """The daily report over the rows that spans stand for."""
    rows = held.select("loan_id", F.explode(F.sequence("valid_from", "valid_to")).alias("balance_date"), *balances.AMOUNTS)
    return accrual.loan_day_report(*b, rows, first, last)


@pytest.mark.parametrize("number", [3, 4])
def test_days_of_spans_equal_the_daily_report(spark, number):
    opened, paid, rng = random_book(spark, number)
    ids = [r.loan_id for r in opened.collect()]
    loans = spark.createDataFrame(
        [(r.loan_id, 2001 + r.loan_id % 5, r.loan_id, "ACTIVE", dt_.datetime.combine(r.balance_date, dt_.time()),
          dt_.datetime(2025, 9, 1), None) for r in opened.collect()], schemas.LOANS,
    )
    offers = spark.createDataFrame([(i, 2001, 1000, "ACTIVE") for i in ids], schemas.OFFERS)
    book = (loans, seed.products_policy(spark), offers, seed.terms(spark))
    daily = payments.daily_totals(paid)
    held = balances.balance_spans(opened, daily, on(45))
    first, last = str(on(5)), str(on(58))
    made = spans.report_spans(*book, daily, held, first, last)
    want = sorted(map(str, spelled_out((*book, daily), held, first, last).collect()))
    assert sorted(map(str, spans.report_between(made).collect())) == want
    some = spans.report_between(made, on(20), on(22), loan_id=ids[3])
    assert sorted(map(str, some.collect())) == [r for r in want if f"loan_id={ids[3]}," in r and any(repr(on(d)) in r for d in (20, 21, 22))]
    assert sorted(map(str, spans.report_on(made, on(31)).collect())) == [r for r in want if repr(on(31)) in r]
    # each span is as long as it can be, and a loan's spans leave no day out
    rows = sorted((tuple(r) for r in made.collect()), key=lambda r: r[:2])
    for a, b in zip(rows, rows[1:]):
        if a[0] == b[0]:
            assert a[2] + dt_.timedelta(days=1) == b[1] and a[3:] != b[3:]
    assert len(rows) < len(want) / 2


def test_spans_of_stored_days_equal_spans_of_spans(spark):
    opened, paid, _ = random_book(spark, 5)
    daily = payments.daily_totals(paid)
    held = balances.balance_spans(opened, daily, on(45))
    stored = balances.one_day_spans(opened.unionByName(balances.catch_up(opened, daily, on(45))))
    loans = opened.select(
        F.col("loan_id").alias("id"), F.lit(2001).alias("product_id"), F.col("loan_id").alias("offer_id"),
        F.lit("ACTIVE").alias("status"), F.col("balance_date").cast("timestamp_ntz").alias("open_dttm"),
    )
    offers = opened.select(F.col("loan_id").alias("id"), F.lit(1000).alias("approved_amount"))
    rows = [
        sorted(map(str, spans.report_spans_fixed(loans, seed.products_flat(spark), offers, seed.terms(spark), daily, x).collect()))
        for x in (held, stored)
    ]
    assert rows[0] == rows[1] != []


@pytest.mark.parametrize("number", [6, 7, 8])
def test_a_rebuild_of_changed_loans_equals_a_full_one(spark, number):
    opened, paid, rng = random_book(spark, number)
    day = on(50)
    history = opened.unionByName(balances.catch_up(opened, payments.daily_totals(paid), day))
    rows = paid.collect()
    changed_rows = [
        (*r[:4], r.payment_amount + 7) if rng.random() < 0.05 else tuple(r) for r in rows if rng.random() > 0.05
    ] + [(9000, 3, "s", dt_.datetime(2025, 1, 2, 5), 40), (9001, 5, "s", dt_.datetime(2025, 2, 3), 0)]
    after = spark.createDataFrame(changed_rows, schemas.PAYMENTS)
    changed = balances.changed_loans(paid, after)
    new, replaced = balances.rebuild_changed(history, payments.daily_totals(after), changed, day)
    concerned = {r.loan_id for r in changed.collect()}
    assert 0 < len(concerned) < 40 and {r.loan_id for r in new.collect()} <= concerned
    got = balances.merge_rebuilt(history, new, replaced)
    assert content(got) == content(opened.unionByName(balances.catch_up(opened, payments.daily_totals(after), day)))


def test_payments_that_moved_within_a_day_change_nothing(spark):
    _, paid, _ = random_book(spark, 9)
    moved = paid.withColumn("payment_dttm", F.date_trunc("day", "payment_dttm").cast("timestamp_ntz"))
    assert balances.changed_loans(paid, moved).count() == 0
    assert balances.changed_loans(paid, paid.limit(0)).count() == paid.select("loan_id").distinct().count()


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_payments_of_other_loans_do_not_reach_the_window(spark):
    opened, paid, _ = random_book(spark, 10)
    changed = balances.changed_loans(paid, paid.filter("id > 3"))
    rows, _ = balances.rebuild_changed(opened, payments.daily_totals(paid), changed, on(50))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.rindex("Window ["):]
    assert "LeftSemi" in below and "LeftSemi" not in text[: text.index("Window [")]


def above(df, what):
    """For each node of the plan that names ``what``, the nodes above it."""
    found, path = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        node = line.lstrip(" :+-")
        depth = len(line) - len(node)
        path = [(d, n) for d, n in path if d < depth]
        if what in node:
            found.append([n for _, n in path])
        path.append((depth, node))
    return found


def test_a_history_held_by_loan_is_rebuilt_without_a_shuffle_of_its_days(spark):
    opened, paid, _ = random_book(spark, 11)
    opened, daily, day = by_key(opened, "loan_id"), payments.daily_totals(by_key(paid, "loan_id")), on(50)
    history = opened.unionByName(balances.catch_up(opened, daily, day))
    after = paid.filter("id % 9 != 0")
    later = payments.daily_totals(after)
    got = balances.merge_rebuilt(
        history, *balances.rebuild_changed(history, later, balances.changed_loans(paid, after), day)
    )
    days = above(got, "explode(sequence(")
    assert len(days) >= 3 and not [n for nodes in days for n in nodes if n.startswith("Exchange")]
    # nor are the rows that stay sorted
    assert not [n for n in days[0] if n.startswith("Sort")]
    assert content(got) == content(opened.unionByName(balances.catch_up(opened, later, day)))


@needs_tables
@pytest.mark.parametrize("name", ["report_slice", "report_on_day", "report_of_range", "report_of_loan"])
def test_no_day_is_made_before_the_filter_of_a_slice(spark, name):
    text = plan(spark, name)
    made = [m.start() for m in re.finditer(r"explode\(sequence\(", text)]
    assert len(made) == (0 if name == "report_on_day" else 1)
    above = text[: made[0]] if made else text[:0]
    assert "Filter" not in above and "valid_from" in text


@needs_tables
def test_spans_shuffle_the_facts_once_and_by_loan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "report_spans")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = text.split("Union")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(loan_id", above)) <= 2 and "rangepartitioning" not in above


@needs_tables
@pytest.mark.parametrize("name", ["report_spans", "loan_day_report", "loan_day_report_fixed"])
def test_facts_held_by_loan_are_not_shuffled_again(spark, name):
    """Balances and totals come by loan, and the loans meet them hashed, so the facts are sorted once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rolled = above(entry.queries()[name](spark, SF), "Generate inline(")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rolled) == 1 and not [n for n in rolled[0] if n.startswith("Exchange")]
    # by loan and day as they are, then by loan and the days on which something changes
    assert len([n for n in rolled[0] if n.startswith("Sort ")]) <= 2
    assert not [n for n in rolled[0] if n.startswith("SortMergeJoin")]


@needs_tables
def test_stored_days_held_by_loan_are_sorted_once_and_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = above(entry.queries()["loan_day_report_stored"](spark, SF), "explode(sequence(_from")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kinds = [[n.split()[0] for n in nodes] for nodes in days]
    assert len(kinds) == 1 and "Exchange" not in kinds[0] and "SortMergeJoin" not in kinds[0]
    assert kinds[0].count("Sort") == 1


def test_payments_stand_on_each_balance_of_their_day(spark):
    """Also where a day's balance is stored twice, on a loan's first day, and on a day without a balance."""
    loans = spark.createDataFrame(
        [(i, 2001, 1, "ACTIVE", dt_.datetime(2025, 1, 3), dt_.datetime(2025, 9, 1), None) for i in (1, 2)], schemas.LOANS
    )
    offers = spark.createDataFrame([(1, 2001, 1000, "ACTIVE")], schemas.OFFERS)
    daily = spark.createDataFrame(
        [(1, on(4), 7, 1), (1, on(5), 8, 2), (1, on(8), 9, 3), (2, on(1), 5, 5), (2, on(6), 6, 6)],
        "loan_id INT, payment_dttm DATE, daily_total_amount BIGINT, payments_count BIGINT",
    )
    stored = spark.createDataFrame(
        [(1, on(4), 9, 0, 0, 9), (1, on(5), 8, 0, 0, 8), (1, on(5), 8, 0, 0, 8)], schemas.BALANCES
    )
    made = accrual.loan_day_report(loans, seed.products_policy(spark), offers, seed.terms(spark), daily, stored, on(0), on(9))
    got = sorted(
        (r.loan_id, (r.report_dt - START).days, r.loan_balance or 0, r.payments_count or 0) for r in made.collect()
    )
    assert got == [
        (1, 2, 0, 0), (1, 3, 0, 0), (1, 4, 9, 1), (1, 5, 8, 2), (1, 5, 8, 2), (1, 6, 0, 0), (1, 7, 0, 0), (1, 8, 0, 3),
        (1, 9, 0, 0), *[(2, d, 0, 6 * (d == 6)) for d in range(2, 10)],
    ]


def test_loans_without_facts_and_days_at_the_bounds(spark):
    """A span from before the calendar, one that ends with it, and loans that have no balance, no payment or no id."""
    loans = spark.createDataFrame(
        [(i, 2001, 1, "ACTIVE", dt_.datetime(2025, 1, d), dt_.datetime(2025, 9, 1), None) for i, d in
         ((1, 2), (2, 9), (3, 12), (4, 30), (None, 3))], schemas.LOANS.replace(" NOT NULL", ""),
    )
    offers = spark.createDataFrame([(1, 2001, 1000, "ACTIVE")], schemas.OFFERS)
    daily = spark.createDataFrame(
        [(1, on(13), 7, 1), (2, on(10), 9, 2), (2, on(11), 9, 2), (2, on(40), 9, 2), (9, on(10), 1, 1)],
        "loan_id INT, payment_dttm DATE, daily_total_amount BIGINT, payments_count BIGINT",
    )
    held = spark.createDataFrame(
        [(1, on(1), on(12), 900, 0, 0, 900), (1, on(14), on(60), 800, 0, 0, 800), (3, on(2), on(15), 1, 1, 1, 3)],
        "loan_id INT, valid_from DATE, valid_to DATE, open_principal INT, open_interest INT, open_vat INT, loan_balance INT",
    )
    made = spans.report_spans(loans, seed.products_policy(spark), offers, seed.terms(spark), daily, held, on(10), on(20))
    got = sorted(
        (r.loan_id, (r.valid_from - START).days, (r.valid_to - START).days, r.loan_balance, r.payments_count)
        for r in made.collect()
    )
    assert got == [
        (1, 10, 12, 900, None), (1, 13, 13, None, 1), (1, 14, 20, 800, None),
        (2, 10, 11, None, 2), (2, 12, 20, None, None), (3, 11, 20, None, None),
    ]


@needs_tables
def test_a_slice_sorts_spans_and_not_days(spark):
    text = plan(spark, "report_slice")
    made = text.index("explode(sequence(")
    assert "Sort" not in text[:made] and "rangepartitioning" not in text[:made] and "rangepartitioning" in text[made:]
    got = [(r.loan_id, r.report_dt) for r in entry.queries()["report_slice"](spark, SF).collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[1].toordinal())) and len(set(got)) == len(got) > 0


@needs_tables
def test_spans_work_balances_and_totals_out_once(spark):
    """One row number is of the rolled balances; totals are summed for the balances and for the report."""
    text = plan(spark, "report_spans")
    assert text.count("row_number()") == 1
    assert len(re.findall(r"functions=\[[^\]]*partial_count", text)) <= 1
    assert text.count("lineitem.parquet") == 2
