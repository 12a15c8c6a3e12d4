"""The report as spans: one row per loan for each stretch of days on which nothing but a day count changes."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import ladder
from ledgerloom.operators.accrual import CALENDAR_END, CALENDAR_START, PAID, REPORT_COLUMNS, loan_attributes
from ledgerloom.operators.balances import AMOUNTS

SPAN_COLUMNS = (
    "loan_id", "valid_from", "valid_to", "product_name", "loan_status", "collection_status", "dpd_rung", "dpd_since",
    *AMOUNTS, *PAID,
)
# What changes between the spans of a loan; the label of a day follows from dpd_rung and dpd_since.
_CHANGING = ("dpd_rung", "dpd_since", *AMOUNTS, *PAID)


def _date(value: str | dt_.date) -> Column:
    return F.lit(str(value)).cast("date")


def _facts(daily: DataFrame, spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each balance span, on its first day, and for each day with payments."""
    held = spans.filter((F.col("valid_to") >= first) & (F.col("valid_from") <= last)).select(
        "loan_id", F.greatest("valid_from", first).alias("_day"), F.struct("valid_to", *AMOUNTS).alias("_now")
    )
    paid = daily.select("loan_id", F.col("payment_dttm").alias("_day"), F.struct("payment_dttm", *PAID).alias("_paid"))
    return held.unionByName(paid.filter(F.col("_day").between(first, last)), allowMissingColumns=True)


def _starts() -> Column:
    """The days on which something can change, of those that a fact stands for (``_day`` .. ``_then`` - 1).

    Its own day, the ones after its payments and after its balance, and those on which a rung's test turns out true:
    without a balance no test does. Before its first fact a loan has neither balance nor payments.
    """
    day, opened, length = F.col("_day"), F.col("open_date"), F.col("period_length")

    def turn(after: Column) -> Column:
        at = F.date_add(opened, (after + 1).cast("int"))
        return F.when((at > day) & (at <= F.col("_now.valid_to")) & (at < F.col("_then")), at)

    ended = F.date_add("_now.valid_to", 1)
    unpaid = F.date_add("_paid.payment_dttm", 1)
    return F.array(
        day,
        F.when((F.col("_earliest") == day) & (F.col("_start") < day), F.col("_start")),
        F.when((unpaid > day) & (unpaid < F.col("_then")), unpaid),
        F.when((ended > day) & (ended < F.col("_then")), ended),
        *[turn(F.lit(k) * length) for k in ladder.RUNGS],
        turn(F.col("periods") * length),
    )


def _spans(
    loans: DataFrame, products: DataFrame, offers: DataFrame, terms: DataFrame, daily: DataFrame, balances: DataFrame,
    start: str | dt_.date, end: str | dt_.date, step: Column,
) -> DataFrame:
    first, last = _date(start), _date(end)
    loan = loan_attributes(loans, products, offers, terms).withColumn("open_date", F.to_date("open_dttm"))
    loan = loan.filter(F.col("loan_id").isNotNull() & (F.col("open_date") <= last)).withColumn("_start", F.greatest("open_date", first))
    facts = _facts(daily, balances, first, last).withColumnRenamed("loan_id", "_loan")
    # facts held by loan are not shuffled, and as the loans are hashed they are sorted once, by loan and day
    met = loan.hint("shuffle_hash").join(
        facts, (F.col("loan_id") == F.col("_loan")) & (F.col("_day") >= F.col("open_date")), "left"
    )
    by_day = Window.partitionBy("loan_id").orderBy("_day")  # with all of a day, as frames of values take it
    day = F.col("_day")
    rows = (
        met.drop("_loan").withColumn("_day", F.coalesce("_day", "_start"))
        .withColumns({
            "_now": F.last("_now", ignorenulls=True).over(by_day),
            "_paid": F.last("_paid", ignorenulls=True).over(by_day),
            "_earliest": F.min("_day").over(by_day),
            "_then": F.lead("_day").over(by_day),
        })
        .filter(F.col("_then").isNull() | (F.col("_then") != day))  # a day counts as it stands after all its facts
        .withColumn("_then", F.coalesce("_then", F.date_add(last, 1)))
        .withColumn("_from", F.explode(_starts())).filter(F.col("_from").isNotNull())
    )
    at, opened = F.col("_from"), F.col("open_date")
    stands = (at >= day) & (at <= F.col("_now.valid_to"))
    rows = rows.withColumns(
        {c: F.when(stands, F.col("_now")[c]) for c in AMOUNTS}
        | {c: F.when(at == F.col("_paid.payment_dttm"), F.col("_paid")[c]) for c in PAID}
    )
    tests = (at, opened, F.col("periods"), F.col("period_length"), F.col("loan_balance"), F.col("approved_amount"), step)
    rung, since = ladder.dpd_rung(*tests)
    # all that changes in a loan's row; the labels that follow from it are made for what is left
    valued = rows.withColumns({"dpd_rung": rung, "dpd_since": since}).select(
        "loan_id", "product_name", "status", at.alias("_day"), F.struct(*_CHANGING).alias("_values")
    )
    in_order = Window.partitionBy("loan_id").orderBy("_day")
    changed = valued.withColumn("_before", F.lag("_values").over(in_order)).filter(
        F.col("_before").isNull() | ~F.col("_values").eqNullSafe(F.col("_before"))
    )
    until = F.coalesce(F.date_sub(F.lead("_day").over(in_order), 1), last)
    made = changed.select("loan_id", day.alias("valid_from"), until.alias("valid_to"), "product_name", "status", "_values.*")
    return made.withColumns({
        "loan_status": ladder.loan_status(F.col("loan_balance"), F.col("status")),
        "collection_status": ladder.collection_of(F.col("dpd_rung")),
    }).select(*SPAN_COLUMNS)


def report_spans_fixed(
    loans: DataFrame, products: DataFrame, offers: DataFrame, terms: DataFrame, daily: DataFrame, balances: DataFrame,
    start: str | dt_.date = CALENDAR_START, end: str | dt_.date = CALENDAR_END,
) -> DataFrame:
    """Spans of the report with rungs at 25, 50 and 75 percent, over the flat products."""
    return _spans(loans, products, offers, terms, daily, balances, start, end, ladder.fixed_step())


def report_spans(
    loans: DataFrame, products: DataFrame, offers: DataFrame, terms: DataFrame, daily: DataFrame, balances: DataFrame,
    start: str | dt_.date = CALENDAR_START, end: str | dt_.date = CALENDAR_END,
) -> DataFrame:
    """(loan_id, valid_from, valid_to, ...): the report's rows, each for the longest stretch of days it holds on.

    ``balances`` are spans too (``balance_spans``, or ``one_day_spans`` of a stored history). A loan's row changes only
    with a payment, a balance or the day after a rung falls due, so those days are found first, the state is carried
    over them, and days on which nothing changed are dropped: no calendar is made. The label of a day is
    ``dpd_rung`` and the days since ``dpd_since``. Rows are shuffled once, by loan, or not at all where balances and
    totals are both held by loan.
    """
    return _spans(loans, products, offers, terms, daily, balances, start, end, ladder.policy_step(F.col("periods")))


def _rows(spans: DataFrame, day: Column) -> DataFrame:
    # what the days of a span share is made once for all of them
    counted = F.when(F.col("dpd_since").isNotNull(), F.concat("dpd_rung", F.lit(": ")))
    label = F.when(F.col("_counted").isNull(), F.col("dpd_rung")).otherwise(
        F.concat("_counted", F.datediff("report_dt", "dpd_since").cast("string"))
    )
    days = spans.withColumn("_counted", counted).withColumn("report_dt", day)
    return days.withColumn("dpd_status", label).select(*REPORT_COLUMNS)


def _of_loan(df: DataFrame, loan_id) -> DataFrame:
    return df if loan_id is None else df.filter(F.col("loan_id") == F.lit(loan_id))


def report_on(spans: DataFrame, day: str | dt_.date, loan_id=None) -> DataFrame:
    """Report rows of one day, of one loan or of all: the spans that hold on it, no other day made."""
    at = _date(day)
    return _rows(_of_loan(spans, loan_id).filter(at.between(F.col("valid_from"), F.col("valid_to"))), at)


def report_between(
    spans: DataFrame, since: str | dt_.date | None = None, until: str | dt_.date | None = None, loan_id=None
) -> DataFrame:
    """Report rows of the days ``since`` .. ``until``, of one loan or of all.

    Spans outside are filtered first, the others are cut to the range, and only then are days made.
    """
    begin, end = F.col("valid_from"), F.col("valid_to")
    chosen = _of_loan(spans, loan_id)
    if since is not None:
        chosen, begin = chosen.filter(end >= _date(since)), F.greatest(begin, _date(since))
    if until is not None:
        chosen, end = chosen.filter(F.col("valid_from") <= _date(until)), F.least(end, _date(until))
    # never empty; the outer form spares a filter that would build each sequence twice
    return _rows(chosen, F.explode_outer(F.sequence(begin, end)))


def report_slice(spans: DataFrame, until: str | dt_.date, loan_id=None) -> DataFrame:
    """Report rows up to a day, of one loan or of all, by loan, newest first.

    A loan's spans do not overlap, so the spans are put in order, and each then gives its days from the last back.
    """
    begin, end = F.col("valid_from"), F.least("valid_to", _date(until))
    chosen = _of_loan(spans, loan_id).filter(begin <= _date(until)).orderBy("loan_id", F.desc("valid_from"))
    return _rows(chosen, F.explode_outer(F.sequence(end, begin)))
