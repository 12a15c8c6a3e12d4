"""Annuity repayment schedules: forecast, re-forecast from payments, packaging."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.annuity import RATE, annuity
from ledgerloom.functions.arith import let, money
from ledgerloom.operators.partitioning import by_key

SCHEDULE_COLUMNS = (
    "loan_id", "version", "payment_number", "payment_date", "total_payment", "principal_part",
    "interest_part", "open_principal", "status",
)
PACKED_KEYS = SCHEDULE_COLUMNS[2:]
# Rates as whole numbers: so many to one.
UNIT = 10**8


def _rate(percent: Column) -> Column:
    return (percent / F.lit(100)).cast(RATE)


def _per(percent: Column) -> Column:
    return (_rate(percent) * UNIT).cast("bigint")


def _cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def _amount(cents: Column) -> Column:
    return money(cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)"))


def _interest(balance: Column, per: Column) -> Column:
    """Interest of one period on a balance, both in cents, half a cent away from zero.

    Whole-number arithmetic, in wider numbers where the product would not fit.
    """
    half = F.when(balance >= 0, F.lit(UNIT // 2)).otherwise(F.lit(-(UNIT // 2)))
    product = F.try_add(F.try_multiply(balance, per), half)
    wide = balance.cast("decimal(16,0)") * per.cast("decimal(14,0)") + half.cast("decimal(9,0)")
    return F.coalesce(
        F.call_function("div", product, F.lit(UNIT).cast("bigint")),
        F.call_function("div", wide, F.lit(UNIT).cast("decimal(9,0)")),
    )


def _at(i: Column, before: Column, after: Column, paid: Column, level: Column, per: Column, **more: Column) -> Column:
    """Where a loan stands after period ``i``. What every step needs is kept here: a column of the row used in the
    step would be worked out anew in each one."""
    return F.struct(
        i.cast("int").alias("i"), before.cast("bigint").alias("before"), after.cast("bigint").alias("after"),
        paid.cast("bigint").alias("paid"), level.cast("bigint").alias("level"), per.cast("bigint").alias("per"),
        *[c.alias(name) for name, c in more.items()],
    )


def _fold(term: Column, seed: Column, step) -> Column:
    """The states after periods 1 .. ``term`` in order; none for a term below one.

    An array grows by copying, so periods are folded in blocks of about the root of ``term``, each block's states
    gathered on their own and appended once: the work is in proportion to the term. A step appends the state before
    it, so that no state is worked out twice; the seed, at period 0, is left out in the end.
    """
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.greatest(term, F.lit(1)))).cast("int"))
    firsts = F.when(term >= 1, F.sequence(F.lit(1), F.greatest(term, F.lit(1)), size)).otherwise(F.array().cast("array<int>"))

    def one(acc: Column, i: Column) -> Column:
        return F.struct(step(acc["at"], i).alias("at"), F.concat(acc["past"], F.array(acc["at"])).alias("past"))

    def block(acc: Column, first: Column) -> Column:
        periods = F.sequence(first, F.least(first + size - 1, term))
        fresh = F.struct(acc["at"].alias("at"), F.slice(F.array(acc["at"]), 1, 0).alias("past"))
        return let(
            F.aggregate(periods, fresh, one),
            lambda done: F.struct(done["at"].alias("at"), F.concat(acc["past"], done["past"]).alias("past")),
        )

    def finished(acc: Column) -> Column:
        every = F.concat(acc["past"], F.array(acc["at"]))
        return F.slice(every, F.lit(2), F.size(every))

    start = let(seed, lambda at: F.struct(at.alias("at"), F.slice(F.array(at), 1, 0).alias("past")))
    return F.aggregate(firsts, start, block, finished)


def schedule_rows(folded: DataFrame, floored: bool = True, carried: tuple[str, ...] = ()) -> DataFrame:
    """Schedule rows of folded loans: (id, start_date, version, steps, and the columns ``carried``).

    With ``floored`` a balance below zero bears no interest, as in a recalculation. A step holds the balance before and after its period and what was paid in it; the parts of the payment follow from
    those, outside of the fold and in generated code. The outer form of inline, with its one empty row dropped, because
    the plain one makes Catalyst add a filter that computes the whole fold again to see whether it is empty.
    """
    rows = folded.select(
        F.col("id").alias("loan_id"), "version", "start_date", *carried, F.inline_outer("steps")
    ).filter(F.col("i").isNotNull())
    before, paid = F.col("before"), F.col("paid")
    accrued = _interest(F.greatest(before, F.lit(0).cast("bigint")) if floored else before, F.col("per"))
    return (
        rows.withColumn("_charged", accrued)
        # a payment covers the interest as far as it goes
        .withColumn("_charged", F.when(paid.isNotNull(), F.least(paid, F.col("_charged"))).otherwise(F.col("_charged")))
        .select(
            "loan_id",
            "version",
            F.col("i").alias("payment_number"),
            F.add_months("start_date", F.col("i")).alias("payment_date"),
            _amount(F.coalesce(paid, before - F.col("after") + F.col("_charged"))).alias("total_payment"),
            _amount(before - F.col("after")).alias("principal_part"),
            _amount(F.col("_charged")).alias("interest_part"),
            _amount(F.col("after")).alias("open_principal"),
            F.when(paid.isNotNull(), F.lit("actual")).otherwise(F.lit("scheduled")).alias("status"),
            *carried,
        )
    )


def forecast_schedule(loans: DataFrame) -> DataFrame:
    """Level-payment schedule of every loan, version 1; the last payment clears the balance.

    A fold over 1..term inside one projection: no shuffle. Due dates all count from the start date,
    so a month-end start clamps each month by itself. ``interest_rate`` is percent per period; at a
    rate of zero the principal is divided evenly.
    """
    term, none = F.col("term_months"), F.lit(None)

    def step(at: Column, i: Column) -> Column:
        after = F.when(i == term, F.lit(0).cast("bigint")).otherwise(
            at["after"] - at["level"] + _interest(at["after"], at["per"])
        )
        return _at(i, at["after"], after, none, at["level"], at["per"])

    level = _cents(annuity(F.col("amount"), _rate(F.col("interest_rate")), term))
    seed = _at(F.lit(0), none, _cents(F.col("amount")), none, level, _per(F.col("interest_rate")))
    folded = loans.withColumn("steps", _fold(term, seed, step)).withColumn("version", F.lit(1))
    return schedule_rows(folded, floored=False)


def period_of(start: Column, paid_on: Column) -> Column:
    """Number of the period (previous due date, due date] holding a payment; below 1 is before it.

    Due dates fall once in each calendar month, so the month difference is the answer or one short
    of it, whatever the clamping at month ends.
    """
    months = (F.year(paid_on) - F.year(start)) * 12 + F.month(paid_on) - F.month(start)
    return F.when(paid_on <= F.add_months(start, months), months).otherwise(months + 1)


def _paid_by_period(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """(id, _paid): what was paid in each period of a loan as (period, cents) in order, one entry a period.

    Payments are summed per loan and day before they meet the loans, so a loan holding much of the table joins as a
    few days; a loan has at most ``term_months`` entries. All groups are by loan, so there is one shuffle of the days,
    in partitions that are not merged: the joins and sums that follow share a task, and each holds rows of its own.
    """
    by_day = payments.groupBy(F.col("loan_id").alias("id"), "payment_date").agg(
        F.sum("payment_amount").alias("_amount")
    )
    period = period_of(F.col("start_date"), F.col("payment_date"))
    return (
        by_key(by_day, "id").join(loans.select("id", "start_date", "term_months"), "id")
        .select("id", period.alias("_period"), "term_months", "_amount")
        .filter(F.col("_period").between(F.lit(1), F.col("term_months")))
        .groupBy("id", "_period").agg(_cents(F.sum("_amount")).alias("_cents"))
        .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("_period", "_cents"))).alias("_paid"))
    )


def newest_version(schedules: DataFrame) -> DataFrame:
    """Highest schedule version per loan."""
    return schedules.groupBy("loan_id").agg(F.max("version").alias("version"))


def recalculate(
    loans: DataFrame, payments: DataFrame, schedules: DataFrame, as_of: str | dt_.date | None = None
) -> DataFrame:
    """Every loan with its new schedule ``version`` and the ``steps`` of its periods, from what was paid in each.

    A period with payments is 'actual': the amount covers interest first, then principal up to the
    balance. Interest left unpaid is not carried on. A period without is 'scheduled': the first of a
    run fixes a level payment over the periods that remain and the run keeps it; the last period, or
    one whose payment exceeds the balance, clears it, and nothing is due once the balance is zero.

    With a day, ``new_status`` is the loan's status on it: cleared loans close; uncleared ones past the last due date
    become overdue unless closed; the rest become active unless closed or overdue; loans without a period keep theirs.
    One fold gives both the schedule (``schedule_rows``) and the status (``refreshed_loans``): nothing is summed or
    joined again for it. Write this frame once where both are to be stored.
    """
    term, none = F.col("term_months"), F.lit(None)

    def step(at: Column, i: Column) -> Column:
        here, balance = F.get("_paid", at["next"]), at["after"]

        def actual(interest: Column) -> Column:
            principal = F.least(here["_cents"] - F.least(here["_cents"], interest), balance)
            return _at(
                i, balance, balance - principal, here["_cents"], at["level"], at["per"],
                projecting=F.lit(False), next=at["next"] + 1,
            )

        def projected(interest: Column, level: Column) -> Column:
            cleared = F.when(balance <= 0, balance).when(i == term, F.lit(0).cast("bigint"))
            after = cleared.otherwise(balance - F.least(level - interest, balance))
            return _at(i, balance, after, none, level, at["per"], projecting=F.lit(True), next=at["next"])

        fixed = _cents(annuity(_amount(balance), _rate(F.col("interest_rate")), term - i + 1))
        level = F.when(at["projecting"], at["level"]).otherwise(fixed)
        return let(
            _interest(F.greatest(F.lit(0).cast("bigint"), balance), at["per"]),
            lambda interest: F.when(here["_period"].eqNullSafe(i), actual(interest)).otherwise(
                let(level, lambda level: projected(interest, level))
            ),
        )

    seed = _at(
        F.lit(0), none, _cents(F.col("amount")), none, F.lit(0), _per(F.col("interest_rate")),
        projecting=F.lit(False), next=F.lit(0),
    )
    newest = newest_version(schedules).select(F.col("loan_id").alias("id"), F.col("version").alias("_version"))
    left = F.try_element_at("steps", F.lit(-1))["after"]
    due = F.when(F.size("steps") > 0, F.add_months("start_date", term))
    status = {} if as_of is None else {"new_status": _status(left, due, as_of)}
    return (
        loans.join(_paid_by_period(loans, payments), "id", "left")
        .withColumn("steps", _fold(term, seed, step))
        .drop("_paid")
        .join(newest, "id", "left")
        .withColumn("version", (F.coalesce("_version", F.lit(0)) + 1).cast("int"))
        .withColumns(status)
        .select(*loans.columns, *status, "version", "steps")
    )


def recalculate_schedule(loans: DataFrame, payments: DataFrame, schedules: DataFrame) -> DataFrame:
    """New schedule version of every loan from what was paid in each period (see ``recalculate``)."""
    return schedule_rows(recalculate(loans, payments, schedules))


def unknown_loans(wanted: DataFrame, loans: DataFrame) -> DataFrame:
    """Requested loan ids that do not exist; recalculating them is an error for the caller to raise."""
    return wanted.join(loans.select("id"), "id", "left_anti")


def _status(left: Column, due: Column, as_of: str | dt_.date) -> Column:
    """Status of a loan with so much left after its last period, due on a day; unknown ones keep theirs."""
    today = F.lit(str(as_of)).cast("date")
    return (
        F.when(left <= 0, F.lit("closed"))
        .when((due < today) & (F.col("status") != "closed"), F.lit("overdue"))
        .when((due >= today) & ~F.col("status").isin("closed", "overdue"), F.lit("active"))
        .otherwise(F.col("status"))
    )


def refreshed_loans(recalculated: DataFrame) -> DataFrame:
    """The loans of ``recalculate`` as of a day, with their new status."""
    return recalculated.withColumn("status", F.col("new_status")).drop("new_status", "version", "steps")


def refresh_loan_status(loans: DataFrame, schedule: DataFrame, as_of: str | dt_.date) -> DataFrame:
    """Loan status from the last row of each loan's newest stored schedule, by the rules of ``recalculate``.

    The last row is found as one number, version and payment together, so that the sums stay hash aggregates.
    """
    at = F.col("version").cast("bigint") * (1 << 31) + F.col("payment_number")
    last = schedule.groupBy(F.col("loan_id").alias("id")).agg(
        F.max_by("open_principal", at).alias("_left"), F.max_by("payment_date", at).alias("_due")
    )
    status = _status(F.col("_left"), F.col("_due"), as_of)
    return loans.join(last, "id", "left").withColumn("status", status).select(*loans.columns)


def latest_version(schedules: DataFrame) -> DataFrame:
    """Rows of each loan's newest version.

    Aggregate and join instead of a window: the maximum combines map-side, and a loan with very many
    rows is not gathered into one task to find it.
    """
    return schedules.join(newest_version(schedules), ["loan_id", "version"], "left_semi")


def package_schedule(schedules: DataFrame) -> DataFrame:
    """One JSON array per loan and version, its rows in payment order; at most one row per period."""
    extra = ["created_at"] if "created_at" in schedules.columns else []
    rows = F.sort_array(F.collect_list(F.struct(*PACKED_KEYS)))
    return schedules.groupBy("loan_id", "version", *extra).agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("repayment_schedule"))
