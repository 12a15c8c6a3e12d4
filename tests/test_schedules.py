import json
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.annuity import annuity
from ledgerloom.operators import payments, schedule
from tests import seed_frames as seed
from tests.seed_frames import day


def rows_of(df, loan):
    rows = df.filter(F.col("loan_id") == loan).orderBy("payment_number").collect()
    return [
        "/".join(str(x) for x in (r.status[0], r.total_payment, r.principal_part, r.interest_part, r.open_principal))
        for r in rows
    ]


def empty_schedules(spark):
    return spark.createDataFrame([], schemas.SCHEDULES)


def test_forecast_golden(spark):
    plan = schedule.forecast_schedule(seed.contracts(spark))
    assert rows_of(plan, 1) == [
        "s/630.94/430.94/200.00/1569.06", "s/630.94/474.03/156.91/1095.03",
        "s/630.94/521.44/109.50/573.59", "s/630.95/573.59/57.36/0.00",
    ]
    assert rows_of(plan, 2) == [
        "s/714.75/394.75/320.00/1605.25", "s/714.75/457.91/256.84/1147.34",
        "s/714.75/531.18/183.57/616.16", "s/714.75/616.16/98.59/0.00",
    ]
    third = plan.filter("loan_id = 3").orderBy("payment_number").collect()
    assert [str(r.total_payment) for r in third] == ["374.89"] * 7 + ["374.86"]
    assert [str(r.open_principal) for r in third] == [
        "1825.11", "1632.73", "1421.11", "1188.33", "932.27", "650.61", "340.78", "0.00",
    ]
    assert [str(r.payment_date) for r in third][:2] == ["2025-02-01", "2025-03-01"]
    assert {r.version for r in third} == {1}


RECALCULATED = {
    "exact": (seed.EXACT, 1, [
        "a/630.94/430.94/200.00/1569.06", "a/630.94/474.03/156.91/1095.03",
        "a/630.94/521.44/109.50/573.59", "a/630.95/573.59/57.36/0.00",
    ]),
    "over": (seed.OVER, 1, [
        "a/630.94/430.94/200.00/1569.06", "a/930.94/774.03/156.91/795.03",
        "s/458.09/378.59/79.50/416.44", "s/458.08/416.44/41.64/0.00",
    ]),
    "early": (seed.EARLY, 1, [
        "a/630.94/430.94/200.00/1569.06", "a/1725.97/1569.06/156.91/0.00",
        "s/0.00/0.00/0.00/0.00", "s/0.00/0.00/0.00/0.00",
    ]),
    "under": (seed.UNDER, 1, [
        "a/300.94/100.94/200.00/1899.06", "a/400.94/211.03/189.91/1688.03",
        "s/972.63/803.83/168.80/884.20", "s/972.62/884.20/88.42/0.00",
    ]),
    "third": (seed.THIRD, 3, [
        "a/374.89/174.89/200.00/1825.11", "a/1200.00/1017.49/182.51/807.62",
        "s/185.44/104.68/80.76/702.94", "s/185.44/115.15/70.29/587.79", "s/185.44/126.66/58.78/461.13",
        "s/185.44/139.33/46.11/321.80", "s/185.44/153.26/32.18/168.54", "s/185.39/168.54/16.85/0.00",
    ]),
}


@pytest.mark.parametrize("name", RECALCULATED)
def test_recalculation_golden(spark, name):
    paid, loan, expected = RECALCULATED[name]
    plan = schedule.recalculate_schedule(
        seed.contracts(spark), seed.contract_payments(spark, paid), empty_schedules(spark)
    )
    assert rows_of(plan, loan) == expected


def test_versions_status_and_package(spark):
    loans, paid = seed.contracts(spark), seed.contract_payments(spark, seed.EARLY)
    first = schedule.forecast_schedule(loans.filter("id <> 2"))
    second = schedule.recalculate_schedule(loans, paid, first)
    assert {(r.loan_id, r.version) for r in second.select("loan_id", "version").distinct().collect()} == {
        (1, 2), (2, 1), (3, 2),
    }
    both = first.unionByName(second)
    newest = schedule.latest_version(both)
    assert newest.count() == second.count() and newest.exceptAll(second).count() == 0

    status = {r.id: r.status for r in schedule.refresh_loan_status(loans, second, "2025-06-01").collect()}
    assert status == {1: "closed", 2: "closed", 3: "closed"}
    open_rows = second.filter("payment_number < 4")
    status = {r.id: r.status for r in schedule.refresh_loan_status(loans, open_rows, "2025-06-01").collect()}
    assert status == {1: "closed", 2: "overdue", 3: "overdue"}
    was_overdue = loans.withColumn("status", F.when(F.col("id") == 3, "overdue").otherwise("active"))
    status = {r.id: r.status for r in schedule.refresh_loan_status(was_overdue, open_rows, "2025-01-05").collect()}
    assert status == {1: "closed", 2: "active", 3: "overdue"}

    packed = {(r.loan_id, r.version): json.loads(r.repayment_schedule) for r in schedule.package_schedule(both).collect()}
    assert len(packed) == 5 and [x["payment_number"] for x in packed[3, 1]] == list(range(1, 9))
    assert list(packed[1, 1][0]) == list(schedule.PACKED_KEYS) and packed[1, 1][0]["total_payment"] == 630.94
    assert [r.id for r in schedule.unknown_loans(spark.createDataFrame([(1,), (9,)], "id INT"), loans).collect()] == [9]


def test_month_end_and_edge_loans(spark):
    rows = [
        (1, Decimal("100.00"), Decimal("0.00"), 3, day("2025-01-31"), "active"),
        (2, Decimal("100.00"), Decimal("5.00"), 0, day("2025-01-31"), "active"),
        (3, Decimal("0.00"), Decimal("5.00"), 2, day("2025-01-31"), "active"),
    ]
    loans = seed.contracts(spark, rows)
    plan = schedule.forecast_schedule(loans)
    assert rows_of(plan, 1) == ["s/33.33/33.33/0.00/66.67", "s/33.33/33.33/0.00/33.34", "s/33.34/33.34/0.00/0.00"]
    dates = [str(r.payment_date) for r in plan.filter("loan_id = 1").orderBy("payment_number").collect()]
    assert dates == ["2025-02-28", "2025-03-31", "2025-04-30"]
    assert rows_of(plan, 2) == [] and rows_of(plan, 3) == ["s/0.00/0.00/0.00/0.00"] * 2
    # a payment on the start date belongs to no period; one on a clamped due date to that period
    paid = seed.contract_payments(
        spark, [(1, "2025-01-31", "50.00"), (1, "2025-02-28", "10.00"), (1, "2025-03-01", "20.00"), (1, "2025-05-01", "9.00")]
    )
    again = schedule.recalculate_schedule(loans, paid, empty_schedules(spark))
    assert rows_of(again, 1) == ["a/10.00/10.00/0.00/90.00", "a/20.00/20.00/0.00/70.00", "s/70.00/70.00/0.00/0.00"]


def cents(x: Fraction) -> Decimal:
    whole, rest = divmod(x * 100, 1)
    return Decimal(int(whole) + (rest >= Fraction(1, 2))) / 100


def test_annuity_rounds_like_exact_arithmetic(spark):
    rng = random.Random(3)
    cases = [(Decimal("147448.35"), Decimal("0.1"), 2), (Decimal("0.25"), Decimal("0"), 2), (Decimal("5"), Decimal("0.1"), 0)]
    for _ in range(400):
        rate = Decimal(rng.choice([0, 100, 1000, 1600, rng.randrange(1, 9999)])) / 10000
        cases.append((Decimal(rng.randrange(1, 10**rng.randrange(3, 12))) / 100, rate, rng.choice([1, 2, 3, 4, 8, 12, 60, 360])))
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)], "k INT, p DECIMAL(14,2), r DECIMAL(14,8), n INT"
    )
    got = {x.k: x.a for x in df.select("k", annuity(F.col("p"), F.col("r"), F.col("n")).alias("a")).collect()}
    for k, (p, r, n) in enumerate(cases):
        P, R = Fraction(p), Fraction(r)
        if n <= 0:
            want = Decimal("0.00")
        elif R == 0:
            want = cents(P / n)
        else:
            grown = (1 + R) ** n
            want = cents(P * R * grown / (grown - 1))
        # sixteen digits of (1 + r)^n allow a last-cent difference only for very large payments
        assert abs(got[k] - want) <= (Decimal("0.01") if p > 10**7 else 0), (p, r, n, got[k], want)


def test_principal_parts_sum_to_the_amount(spark):
    loans = seed.contracts(spark, [
        (i, Decimal(1000 + 37 * i).quantize(Decimal("0.01"), ROUND_HALF_UP), Decimal(i % 7), 1 + i % 12, day("2025-01-31"), "active")
        for i in range(100)
    ])
    sums = schedule.forecast_schedule(loans).groupBy(F.col("loan_id").alias("id")).agg(F.sum("principal_part").alias("s"))
    assert loans.join(sums, "id").filter("s <> amount").count() == 0


def test_billing_month(spark):
    got = payments.payments_by_billing_month(seed.contract_payments(spark, seed.EXACT)).orderBy("month").collect()
    assert [(str(r.month), str(r.total_payment_amount)) for r in got] == [
        ("2025-02-01", "630.94"), ("2025-03-01", "630.94"), ("2025-04-01", "630.94"), ("2025-05-01", "630.95"),
    ]


def half_up(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_long_terms_and_large_amounts_equal_a_loop(spark):
    """Blocks of periods, whole-number interest and its decimal stand-in give what stepping gives."""
    terms, amounts = (1, 2, 3, 59, 60, 61, 121, 360), ("0.05", "1234.56", "99999999.99", "500000000000.00")
    rows = [
        (i, Decimal(a), Decimal(r), n, day("2024-01-31"), "active")
        for i, (n, a, r) in enumerate((n, a, r) for n in terms for a in amounts for r in ("0.00", "1.37", "12.50"))
    ]
    loans = seed.contracts(spark, rows)
    level = {x.id: x.level for x in loans.select(
        "id", annuity(F.col("amount"), (F.col("interest_rate") / 100).cast("decimal(14,8)"), F.col("term_months")).alias("level")
    ).collect()}
    got = {}
    for r in schedule.forecast_schedule(loans).collect():
        got[r.loan_id, r.payment_number] = (r.total_payment, r.principal_part, r.interest_part, r.open_principal)
    want = {}
    for key, amount, rate, n, _, _ in rows:
        balance = amount
        for i in range(1, n + 1):
            interest = half_up(balance * rate / 100)
            principal = balance if i == n else level[key] - interest
            balance -= principal
            want[key, i] = (principal + interest, principal, interest, balance)
    assert got == want


def test_one_recalculation_gives_schedule_and_status(spark, tmp_path):
    loans = seed.contracts(spark)
    path = str(tmp_path / "paid")
    seed.contract_payments(spark, seed.EARLY + [(2, d, a) for _, d, a in seed.UNDER] + [(2, "2025-04-15", "9.00")]).write.parquet(path)
    paid = spark.read.parquet(path)
    done = schedule.recalculate(loans, paid, empty_schedules(spark), "2025-06-01")
    rows = schedule.schedule_rows(done)
    separate = schedule.recalculate_schedule(loans, paid, empty_schedules(spark))
    assert sorted(map(str, rows.collect())) == sorted(map(str, separate.collect()))
    want = schedule.refresh_loan_status(loans, separate, "2025-06-01")
    got = schedule.refreshed_loans(done)
    assert got.columns == loans.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    both = schedule.schedule_rows(done, carried=("new_status",))
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    status = {r.id: r.status for r in want.collect()}
    assert {(r.loan_id, r.new_status) for r in both.collect()} == set(status.items()) == {(1, "closed"), (2, "overdue"), (3, "closed")}


def test_paid_days_are_dealt_by_loan_in_partitions_that_are_not_merged(spark, tmp_path):
    """Loans whose paid days differ in number give the rows of a plain sum."""
    loans = seed.contracts(spark, [(i, Decimal("900.00"), Decimal("0.00"), 3, day("2025-01-01"), "active") for i in range(40)])
    rows = [(i, f"2025-01-{d + 2:02d}", "1.00") for i in range(40) for d in range(i % 5)] * 2
    path = str(tmp_path / "paid")
    seed.contract_payments(spark, rows).write.parquet(path)
    done = schedule.recalculate_schedule(loans, spark.read.parquet(path), empty_schedules(spark))
    assert "REPARTITION_BY_NUM" in done._jdf.queryExecution().executedPlan().toString()
    first = {r.loan_id: (r.status, r.total_payment) for r in done.filter("payment_number = 1").collect()}
    assert first == {i: ("actual", Decimal(2 * (i % 5))) if i % 5 else ("scheduled", Decimal(300)) for i in range(40)}


def test_loans_without_a_period_keep_their_status(spark):
    loans = seed.contracts(spark, [(1, Decimal("5.00"), Decimal("1.00"), 0, day("2025-01-31"), "active")])
    done = schedule.recalculate(loans, seed.contract_payments(spark, []), empty_schedules(spark), "2026-01-01")
    assert schedule.schedule_rows(done).count() == 0
    assert [r.status for r in schedule.refreshed_loans(done).collect()] == ["active"]


def test_money_columns_are_decimals(spark):
    plan = schedule.forecast_schedule(seed.contracts(spark))
    kinds = {f.name: f.dataType.simpleString() for f in plan.schema}
    for c in ("total_payment", "principal_part", "interest_part", "open_principal"):
        assert kinds[c] == "decimal(14,2)"
    again = schedule.recalculate_schedule(seed.contracts(spark), seed.contract_payments(spark, seed.EXACT), plan)
    assert {f.name: f.dataType.simpleString() for f in again.schema} == kinds
    assert tuple(plan.columns) == tuple(again.columns) == schedule.SCHEDULE_COLUMNS
