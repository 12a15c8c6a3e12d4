import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import accrual, balances, opening, payments, rewrites
from ledgerloom.plans.daily_cycle import add_loans_flat, add_loans_policy, close_day, close_one_day
from ledgerloom.sources.tables import replace_from, write_partitions
from tests import seed_frames as seed
from tests.seed_frames import day

WALK_FLAT = [(14786, 0, 0, 14786), (12986, 0, 0, 12986), (9836, 0, 0, 9836), (9836, 0, 0, 9836), (1386, 0, 0, 1386)]
WALK_POLICY = [(15922, 0, 0, 15922), (14122, 0, 0, 14122), (10972, 0, 0, 10972), (10972, 0, 0, 10972), (2522, 0, 0, 2522)]


def amounts(df):
    rows = df.orderBy("loan_id", "balance_date").collect()
    return [(r.open_principal, r.open_interest, r.open_vat, r.loan_balance) for r in rows]


def opened(spark, kind):
    if kind == "flat":
        return opening.open_balances_flat(seed.loans(spark), seed.products_flat(spark), seed.offers(spark))
    return opening.open_balances_policy(
        seed.loans(spark), seed.products_policy(spark), seed.offers(spark), seed.terms(spark)
    )


@pytest.mark.parametrize("kind, expected", [("flat", (16000, 1195, 191, 17386)), ("policy", (16000, 2174, 348, 18522))])
def test_opening_balance(spark, kind, expected):
    assert amounts(opened(spark, kind)) == [expected]


def test_terms(spark):
    rows = {r.policy_id: r for r in opening.expand_terms(seed.terms(spark)).collect()}
    assert (rows[6001].period_1, rows[6001].period_2, rows[6001].period_3, rows[6001].horizon_days) == (31, 62, 93, 124)
    assert (rows[6003].periods, rows[6003].period_length, rows[6003].total_interest_rate) == (31, 4, 40)


@pytest.mark.parametrize("kind, expected", [("flat", WALK_FLAT), ("policy", WALK_POLICY)])
def test_waterfall_day_by_day_and_at_once(spark, kind, expected):
    daily = payments.daily_totals(seed.payments(spark, seed.WALKTHROUGH))
    history = opened(spark, kind)
    at_once = balances.rebuild_balances(history, daily, "2025-03-18", "2025-03-23")
    assert amounts(at_once)[1:] == expected
    for want in expected:
        rolled = balances.roll_one_day(history, daily)
        assert amounts(rolled) == [want]
        history = spark.createDataFrame(history.unionByName(rolled).collect(), schemas.BALANCES)


def test_loading_a_batch(spark):
    args = (seed.old_loans(spark), seed.old_balances(spark), seed.loans(spark))
    loans, flat = add_loans_flat(*args, seed.products_flat(spark), seed.offers(spark))
    assert [r.id for r in loans.orderBy("id").collect()] == [3001, 3004]
    assert amounts(flat) == [(16000, 1195, 191, 17386), (0, 0, 0, 0)]
    # a second run of the same batch changes nothing
    loans, again = add_loans_policy(
        loans, flat, seed.loans(spark), seed.products_policy(spark), seed.offers(spark), seed.terms(spark)
    )
    assert loans.count() == 2 and amounts(again) == [(16000, 2174, 348, 18522), (0, 0, 0, 0)]


def test_closing_a_day_keeps_settled_loans_out(spark):
    history = opened(spark, "flat").unionByName(seed.old_balances(spark))
    closed = close_day(history, seed.payments(spark, seed.WALKTHROUGH))
    assert amounts(closed) == [(16000, 1195, 191, 17386), WALK_FLAT[0], (0, 0, 0, 0)]


def test_delinquency_report(spark):
    products = rewrites.set_where(
        seed.products_policy(spark), F.col("product_name") == "general_loan", "policy_id", 6003
    )
    args = (seed.loans(spark), products, seed.offers(spark), seed.terms(spark))
    paid = seed.payments(spark, seed.DELINQUENT)
    history = balances.rebuild_balances(
        opening.open_balances_policy(*args[:2], *args[2:]), payments.daily_totals(paid), "2025-03-18", "2025-03-31"
    )
    report = accrual.loan_day_report(*args, payments.daily_totals(paid), history)
    rows = {
        str(r.report_dt): (r.open_principal, r.open_interest, r.open_vat, r.loan_balance, r.collection_status, r.dpd_status)
        for r in accrual.report_slice(report, "2025-03-30", 3001).collect()
    }
    expected = {
        "2025-03-17": (16000, 2174, 348, 18522, "OK", "OK"),
        "2025-03-18": (16000, 1822, 0, 17822, "OK", "OK"),
        "2025-03-20": (16000, 572, 0, 16572, "OK", "OK"),
        "2025-03-21": (16000, 572, 0, 16572, "OK", "OK"),
        "2025-03-22": (16000, 372, 0, 16372, "WARNING:1", "P1: 1"),
        "2025-03-23": (16000, 72, 0, 16072, "WARNING:1", "P1: 2"),
        "2025-03-24": (15672, 0, 0, 15672, "WARNING:1", "P1: 3"),
        "2025-03-25": (15272, 0, 0, 15272, "OK", "OK"),
        "2025-03-26": (15022, 0, 0, 15022, "OK", "OK"),
        "2025-03-30": (13392, 0, 0, 13392, "OK", "OK"),
    }
    assert {k: rows[k] for k in expected} == expected
    assert len(rows) == 14
    # the calendar runs to its end; days without a balance say so
    assert report.count() == 291
    last = report.filter("report_dt = '2026-01-01'").first()
    assert last.loan_status == "NO BALANCE DATA" and last.collection_status == "OK"
    counts = {str(r.report_dt): r.payments_count for r in report.filter("daily_total_amount > 0").collect()}
    assert counts["2025-03-20"] == 2 and len(counts) == 11


def test_report_of_two_days(spark):
    daily = payments.daily_totals(seed.payments(spark, seed.WALKTHROUGH))
    report = accrual.loan_day_report_fixed(
        seed.loans(spark), seed.products_flat(spark), seed.offers(spark), seed.terms(spark), daily,
        opened(spark, "flat"), "2025-03-17", "2025-03-18",
    )
    rows = report.orderBy("report_dt").collect()
    assert [(r.loan_status, r.daily_total_amount, r.payments_count) for r in rows] == [
        ("ACTIVE", None, None), ("NO BALANCE DATA", 2600, 3),
    ]


@pytest.mark.parametrize("copies", [1, 2])
def test_report_of_events_before_the_opening_and_of_repeated_rows(spark, copies):
    """Days before the opening do not count; each event of a repeated row stands once a copy, an empty day once."""
    balance = opened(spark, "flat").limit(1)
    history = balance.unionByName(balance.withColumn("balance_date", F.lit("2025-03-10").cast("date")))
    history = history.unionByName(balance.withColumn("balance_date", F.lit("2025-03-19").cast("date")))
    paid = seed.payments(spark, [
        (1, 3001, "x", "2025-03-12 09:00:00", 5), (2, 3001, "x", "2025-03-19 09:00:00", 7), (3, 3001, "x", "2025-03-21 09:00:00", 9),
    ])
    loan = seed.loans(spark).filter("id = 3001")
    loans = loan.withColumn("open_dttm", F.lit("2025-03-15").cast("timestamp_ntz"))
    for _ in range(copies - 1):
        loans = loans.unionByName(loans)
    report = accrual.loan_day_report_fixed(
        loans, seed.products_flat(spark), seed.offers(spark), seed.terms(spark), payments.daily_totals(paid),
        history, "2025-03-11", "2025-03-22",
    )
    rows = sorted((r.report_dt.day, r.loan_balance is not None, r.daily_total_amount, r.loan_status) for r in report.collect())
    events = {17: (True, None, "ACTIVE"), 19: (True, 7, "ACTIVE"), 21: (False, 9, "NO BALANCE DATA")}
    assert [(r[0], *r[1:]) for r in rows] == [
        (day, *events.get(day, (False, None, "NO BALANCE DATA")))
        for day in range(15, 23) for _ in range(copies if day in events else 1)
    ]


def test_payment_upsert_cut_and_replay(spark):
    table = seed.payments(spark, [(4009, 3004, "ride_payment", "2025-03-06 19:00:00", 690)] + seed.WALKTHROUGH[:3])
    staged = seed.payments(spark, [(4100, 3001, "ride_payment", "2025-03-18 11:00:00", 1)] + seed.WALKTHROUGH[3:])
    one_day = rewrites.upsert_payments(table, staged, "2025-03-18")
    assert sorted((r.id, r.payment_amount) for r in one_day.collect()) == [
        (4009, 690), (4100, 1), (4101, 800), (4102, 1100),
    ]
    replayed = rewrites.rebuild_payments(table, staged, "2025-03-18", "2025-03-20")
    assert sorted(r.id for r in replayed.collect()) == [4009, 4100, 4106]
    cut = rewrites.cut_from(one_day, "2025-03-18", "payment_dttm", loan_id=3001)
    assert [r.id for r in cut.collect()] == [4009]


def replay(table, staged, first, last):
    """The day loop that ``rebuild_payments`` replaces."""
    table = [p for p in table if p[3] < first]
    when = dt.date.fromisoformat(first)
    while str(when) < last:
        today = [p for p in staged if p[3][:10] == str(when)]
        table = [p for p in table if p[0] not in {t[0] for t in today}] + today
        when += dt.timedelta(days=1)
    return sorted(table)


def test_replay_equals_the_day_loop(spark):
    rng = random.Random(5)

    def some(ids):
        return [
            (i, rng.randrange(3), "ride_payment", f"2025-03-{rng.randrange(10, 28)} 0{rng.randrange(10)}:00:00", rng.randrange(99))
            for i in ids
        ]

    table, staged = some(range(60)), some(range(30, 100))
    got = rewrites.rebuild_payments(
        seed.payments(spark, table), seed.payments(spark, staged), "2025-03-15", "2025-03-22"
    ).collect()
    assert sorted((r.id, r.loan_id, r.source, str(r.payment_dttm), r.payment_amount) for r in got) == replay(
        table, staged, "2025-03-15", "2025-03-22"
    )


def walk(base, paid, days):
    """Plain day-by-day waterfall of one loan, written from the rules."""
    date, p, i, v, b = base
    out = []
    for _ in range(days):
        if b == 0:
            break
        date += dt.timedelta(days=1)
        amount = paid.get(date)
        if amount is not None:
            left = v - amount
            if i + left <= 0:
                p = p + i + left
            if left <= 0:
                i = max(i + left, 0)
            v = max(left, 0)
            b = b - amount
        out.append((date, p, i, v, b))
    return out


def test_one_pass_equals_day_loop_with_refunds_and_settlement(spark):
    rng = random.Random(11)
    base, daily, expected = [], [], []
    start = day("2025-01-10")
    for loan in range(300):
        p, i, v = rng.randrange(1, 60), rng.randrange(0, 20), rng.randrange(0, 8)
        opened_on = start + dt.timedelta(days=rng.randrange(4))
        paid = {
            opened_on + dt.timedelta(days=rng.randrange(0, 14)): rng.choice([-9, -3, 0, 2, 5, 7, 11, 20, p, p + i + v])
            for _ in range(rng.randrange(0, 8))
        }
        base.append((loan, opened_on, p, i, v, p + i + v))
        # an older row that must not be the one rolled from
        base.append((loan, opened_on - dt.timedelta(days=1), p + 5, i, v, p + 5 + i + v))
        daily += [(loan, d, a) for d, a in paid.items()]
        expected += [(loan, *row) for row in walk((opened_on, p, i, v, p + i + v), paid, 12)]
    history = spark.createDataFrame(base, schemas.BALANCES)
    totals = spark.createDataFrame(daily, "loan_id INT, payment_dttm DATE, daily_total_amount BIGINT")
    rebuilt = balances.rebuild_balances(history, totals, "2025-01-20", "2025-02-01")
    got = sorted(tuple(r) for r in rebuilt.join(history, ["loan_id", "balance_date"], "left_anti").select(
        "loan_id", "balance_date", "open_principal", "open_interest", "open_vat", "loan_balance").collect())
    assert got == sorted(expected)
    assert any(r[-1] == 0 for r in got) and any(r[-1] < 0 for r in got)


def test_rebuild_drops_loans_opened_later_and_never_skips_a_day(spark):
    rows = [(1, day("2025-01-01"), 10, 1, 1, 12), (1, day("2025-01-02"), 9, 0, 0, 9), (2, day("2025-01-05"), 10, 1, 1, 12)]
    totals = spark.createDataFrame([(1, day("2025-01-04"), 4)], "loan_id INT, payment_dttm DATE, daily_total_amount BIGINT")
    rebuilt = balances.rebuild_balances(spark.createDataFrame(rows, schemas.BALANCES), totals, "2025-01-02", "2025-01-06")
    got = [(r.loan_id, str(r.balance_date), r.loan_balance) for r in rebuilt.orderBy("balance_date").collect()]
    assert got == [(1, f"2025-01-0{d}", b) for d, b in ((1, 12), (2, 12), (3, 12), (4, 8), (5, 8))]


def test_a_large_loan_day_is_one_row_and_every_id_stands_once(spark):
    rows = [(i, 1, "ride_payment", "2025-03-18 11:00:00", 1) for i in range(5000)]
    rows += [(9000 + i, 2, "ride_payment", f"2025-03-1{i} 09:00:00", 5) for i in range(3)]
    paid = seed.payments(spark, rows)
    totals = payments.daily_totals(paid).collect()
    assert [(r.daily_total_amount, r.payments_count) for r in totals if r.loan_id == 1] == [(5000, 5000)]
    assert [(r.daily_total_amount, r.payments_count) for r in totals if r.loan_id == 2] == [(5, 1)] * 3
    ids = payments.payment_ids(paid).collect()
    assert sorted(r.id for r in ids) == sorted(r[0] for r in rows)
    report = accrual.loan_day_report_fixed(
        seed.loans(spark).withColumn("id", F.lit(1)).limit(1), seed.products_flat(spark), seed.offers(spark),
        seed.terms(spark), payments.daily_totals(paid), opened(spark, "flat"), "2025-03-18", "2025-03-18",
    )
    assert [(r.daily_total_amount, r.payments_count) for r in report.collect()] == [(5000, 5000)]


def test_totals_of_some_days(spark):
    paid = seed.payments(spark, [(i, 1, "x", f"2025-03-1{i} 09:00:00", 5) for i in range(5)])
    days = [str(r.payment_dttm) for r in payments.daily_totals(paid, "2025-03-11", "2025-03-13").collect()]
    assert sorted(days) == ["2025-03-11", "2025-03-12"]


def test_one_day_closed_alone(spark):
    history = opened(spark, "flat")
    paid = seed.payments(spark, seed.WALKTHROUGH)
    assert amounts(close_one_day(history, paid, "2025-03-18")) == [WALK_FLAT[0]]
    assert close_one_day(history, paid, "2025-03-20").count() == 0


def test_rows_from_a_day_on_are_replaced(spark, tmp_path):
    path = str(tmp_path / "balances")
    rows = [(1, day(f"2025-01-0{d}"), 10 - d, 0, 0, 10 - d) for d in range(1, 6)]
    old = spark.createDataFrame(rows, schemas.BALANCES)
    write_partitions(old, path, "balance_date")
    new = spark.createDataFrame([(2, day("2025-01-03"), 5, 0, 0, 5)], schemas.BALANCES)
    for _ in range(2):
        assert replace_from(new, path, "balance_date", "2025-01-03") == 1
        got = sorted((r.loan_id, str(r.balance_date)) for r in spark.read.parquet(path).collect())
        assert got == [(1, "2025-01-01"), (1, "2025-01-02"), (2, "2025-01-03")]


@pytest.mark.parametrize("config, rate", [
    ('{"periods": 4, "period_length": 31, "total_interest_rate": "40"}', 40),
    ('{"periods": 4, "period_length": 31, "total_interest_rate": 40.5}', None),
    ('{"periods": 4, "period_length"', None),
])
def test_policies_are_read_strictly(spark, config, rate):
    terms = spark.createDataFrame([(1, config)], "id INT, policy_config STRING")
    if rate is None:
        with pytest.raises(Exception, match="MALFORMED|CAST_INVALID"):
            opening.parse_terms(terms).collect()
    else:
        assert opening.parse_terms(terms).first().total_interest_rate == rate


def test_slices_and_offers(spark):
    paid = seed.payments(spark, seed.WALKTHROUGH)
    newest = accrual.payment_slice(paid, "2025-03-20", 3001).collect()
    assert [r.id for r in newest] == [4109, 4108, 4107]
    assert [r.id for r in accrual.active_offers(seed.offers(spark)).collect()] == [7001]
    assert accrual.balance_slice(seed.old_balances(spark), 3004).count() == 1


def test_column_defaults(spark):
    rows = spark.createDataFrame([(1, None), (2, "paid")], "id INT, status STRING")
    filled = schemas.with_defaults(rows, status="scheduled")
    assert [r.status for r in filled.orderBy("id").collect()] == ["scheduled", "paid"]
