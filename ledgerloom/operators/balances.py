"""Rolling balances forward through the daily payment waterfall: VAT, then interest, then principal."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AMOUNTS = ("open_principal", "open_interest", "open_vat", "loan_balance")
BALANCE_COLUMNS = ("loan_id", "balance_date", *AMOUNTS)


def _amount_by_day(daily: DataFrame, day: str, amount: str) -> DataFrame:
    return daily.select("loan_id", F.col("payment_dttm").alias(day), F.col("daily_total_amount").alias(amount))


def latest_open(balances: DataFrame) -> DataFrame:
    """Newest row per loan, without loans that stand at exactly zero.

    ``max_by`` on plain integers keeps this a hash aggregate that combines map-side; no group is
    sorted and one long history costs no more than many short ones.
    """
    newest = balances.groupBy("loan_id").agg(
        F.max("balance_date").alias("balance_date"),
        *[F.max_by(c, "balance_date").alias(c) for c in AMOUNTS],
    )
    return newest.filter(F.col("loan_balance") != 0)


def _after(paid: Column, spill: Column) -> dict[str, Column]:
    """Balances once ``paid`` in all has come in, of which ``spill`` ran past the VAT."""
    principal, interest, vat, total = (F.col(c) for c in AMOUNTS)
    return {
        "open_vat": (vat - paid + spill).cast("int"),
        "open_interest": F.greatest(interest - spill, F.lit(0)).cast("int"),
        "open_principal": (principal - F.greatest(spill - interest, F.lit(0))).cast("int"),
        "loan_balance": (total - paid).cast("int"),
    }


def roll_one_day(balances: DataFrame, daily: DataFrame) -> DataFrame:
    """The row after each loan's newest one; loans at exactly zero are not rolled.

    Only payments of the very next day count, so one on the opening day is never applied. Principal
    and balance have no floor: an overpaid loan goes negative and keeps rolling. Where every open loan
    stands at the same day, pass that day's balances and the next day's payments: partition pruning
    then keeps the rest of both tables unread.
    """
    due = latest_open(balances).withColumn("balance_date", F.date_add("balance_date", 1))
    paid = _amount_by_day(daily, "_day", "_amount")
    # the day as a range, not as a key: payments held by loan are not shuffled again by loan and day
    on_day = F.col("balance_date").between(F.col("p._day"), F.col("p._day"))
    amount = F.col("_amount")
    spill = F.greatest(amount - F.col("open_vat"), F.lit(0))
    rolled = {c: F.when(amount.isNull(), F.col(c)).otherwise(e) for c, e in _after(amount, spill).items()}
    paydays = due.alias("b").join(paid.alias("p"), (F.col("b.loan_id") == F.col("p.loan_id")) & on_day, "left")
    return paydays.select("b.*", "_amount").withColumns(rolled).select(*BALANCE_COLUMNS)


def _running_balances(base: DataFrame, daily: DataFrame, last: Column) -> DataFrame:
    """Spans of days over which a loan's balances stand still, from its base date + 1 to its ``last`` day.

    With C the payments so far, the part that ran past the VAT is L = max(0, max over days of C) - vat,
    floored at zero: a refund refills VAT but returns nothing from interest or principal. Interest and
    principal then depend on L alone. So the whole history is one running sum and one running maximum
    per loan, over its payment days only; days without payment are filled in afterwards, unshuffled.
    """
    base = base.withColumn("_last", last).withColumnRenamed("balance_date", "_base")
    paid = _amount_by_day(daily, "_day", "_amount")
    in_reach = (F.col("_day") > F.col("_base")) & (F.col("_day") <= F.col("_last"))
    by_day = Window.partitionBy("loan_id").orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)

    paydays = (
        # one row of a loan against all its paydays: the rows are hashed and the paydays sorted once, by loan and day
        base.alias("b").hint("shuffle_hash")
        .join(paid.alias("p"), (F.col("b.loan_id") == F.col("p.loan_id")) & in_reach, "left")
        .select("b.*", "p._day", "p._amount")
        .withColumn("_paid", F.sum(F.coalesce("_amount", F.lit(0))).over(so_far))
        .withColumn("_next", F.lead("_day").over(by_day))
        .withColumn("_nth", F.row_number().over(by_day))
        .withColumn("_peak", F.max("_paid").over(so_far))
        .withColumn("_settled", F.coalesce(F.max(F.col("_paid") == F.col("loan_balance")).over(earlier), F.lit(False)))
        .filter(~F.col("_settled"))
    )
    # before the first payment day the opening amounts stand; from each payment day its own do
    opening = F.struct(
        F.date_add("_base", 1).alias("_from"),
        F.coalesce(F.date_sub("_day", 1), F.col("_last")).alias("_to"),
        F.lit(0).cast("bigint").alias("_paid"),
        F.lit(0).cast("bigint").alias("_peak"),
    )
    current = F.struct(
        F.col("_day").alias("_from"),
        F.coalesce(F.date_sub("_next", 1), F.col("_last")).alias("_to"),
        F.col("_paid"),
        F.col("_peak"),
    )
    pieces = F.when(F.col("_nth") == 1, F.array(opening, current)).otherwise(F.array(current))
    spans = paydays.select("loan_id", *AMOUNTS, F.inline_outer(pieces)).filter(F.col("_from") <= F.col("_to"))
    spill = F.greatest(F.col("_peak") - F.col("open_vat"), F.lit(0))
    # a balance of exactly zero is written once and ends the loan
    return spans.withColumns(_after(F.col("_paid"), spill)).withColumn(
        "_to", F.when(F.col("loan_balance") == 0, F.col("_from")).otherwise(F.col("_to"))
    )


def _days(spans: DataFrame) -> DataFrame:
    # spans are never empty; the outer form spares a filter that would build each sequence twice
    return spans.select("loan_id", F.explode_outer(F.sequence("_from", "_to")).alias("balance_date"), *AMOUNTS)


def roll_forward(
    balances: DataFrame, daily: DataFrame, dt: str | dt_.date, as_of: str | dt_.date
) -> DataFrame:
    """The as_of - dt days after each loan's newest row before ``dt``: the new rows only.

    For a stored history this is what to write over the partitions from ``dt`` on.
    """
    rolls = (dt_.date.fromisoformat(str(as_of)) - dt_.date.fromisoformat(str(dt))).days
    base = latest_open(_before(balances, dt))
    return _days(_running_balances(base if rolls > 0 else base.limit(0), daily, F.date_add("balance_date", rolls)))


def _until(day: str | dt_.date) -> Column:
    return F.lit(str(day)).cast("date")


def catch_up(balances: DataFrame, daily: DataFrame, day: str | dt_.date) -> DataFrame:
    """The missing rows of every loan through ``day``, each from its own newest row on: the new rows only.

    Equal to calling ``roll_one_day`` again and again for the loans that have not reached ``day``. Loans that stand
    at zero, or at ``day`` or later, get no rows. ``daily`` need not reach back before the oldest newest row;
    ``plans.daily_cycle.catch_up_day`` prunes payments to it.
    """
    return _days(_running_balances(latest_open(balances), daily, _until(day)))


def balance_spans(balances: DataFrame, daily: DataFrame, day: str | dt_.date) -> DataFrame:
    """(loan_id, valid_from, valid_to, amounts): the stored rows, caught up through ``day``, as spans of days.

    A loan has a span for each payment day and one between two, so this stays as small as the payments however long
    the history gets. Stored rows are spans of one day.
    """
    rolled = _running_balances(latest_open(balances), daily, _until(day)).select(
        "loan_id", F.col("_from").alias("valid_from"), F.col("_to").alias("valid_to"), *AMOUNTS
    )
    return one_day_spans(balances).unionByName(rolled)


def one_day_spans(balances: DataFrame) -> DataFrame:
    """Stored daily rows in the form of ``balance_spans``."""
    return balances.select(
        "loan_id", F.col("balance_date").alias("valid_from"), F.col("balance_date").alias("valid_to"), *AMOUNTS
    )


def _before(balances: DataFrame, dt: str | dt_.date) -> DataFrame:
    return balances.filter(F.col("balance_date") < F.lit(str(dt)).cast("date")).select(*BALANCE_COLUMNS)


def rebuild_balances(
    balances: DataFrame, daily: DataFrame, dt: str | dt_.date, as_of: str | dt_.date
) -> DataFrame:
    """History before ``dt`` plus as_of - dt further days per loan, from its newest surviving row.

    Equal to dropping rows from ``dt`` on and calling ``roll_one_day`` once per day up to ``as_of``.
    A loan whose rows are all dropped is not opened again. Opening VAT and interest are taken to be
    non-negative, as the opening operators make them.
    """
    return _before(balances, dt).unionByName(roll_forward(balances, daily, dt, as_of))


def changed_loans(before: DataFrame, after: DataFrame) -> DataFrame:
    """(loan_id, changed_from): the loans whose total of some day differs between two states of the payments.

    Amounts before count negative and amounts after positive, so one sum per loan and day, combined map-side, finds
    what is missing on either side; rows that did not change cancel out. Where only some payments can have changed,
    pass those alone: their rows before and their rows after.
    """
    signed = [
        rows.select("loan_id", F.to_date("payment_dttm").alias("_day"), (F.col("payment_amount") * sign).alias("_amount"))
        for rows, sign in ((after, 1), (before, -1))
    ]
    differing = (
        signed[0].unionByName(signed[1]).filter(F.col("loan_id").isNotNull())
        .groupBy("loan_id", "_day").agg(F.sum("_amount").alias("_amount")).filter(F.col("_amount") != 0)
    )
    return differing.groupBy("loan_id").agg(F.min("_day").alias("changed_from"))


def rebuild_changed(
    balances: DataFrame, daily: DataFrame, changed: DataFrame, day: str | dt_.date
) -> tuple[DataFrame, DataFrame]:
    """New rows of the changed loans through ``day``, and what they replace as (loan_id, changed_from).

    ``changed`` comes from ``changed_loans``, ``daily`` is of the payments after the change. Each loan is rolled again
    from its newest row before its own first changed day; rows and payments of other loans are dropped before any
    window or sort. A payment on or before the opening day never counts, so a loan always keeps its first row.
    A history held by loan (``by_key``) is neither shuffled nor sorted to find its rows.
    """
    # a loan is at most one row of them, so the changed loans are the side to hash, whatever the size of the history
    own = balances.select(*BALANCE_COLUMNS).join(changed.hint("shuffle_hash"), "loan_id")
    since = F.greatest(F.first("changed_from"), F.date_add(F.min("balance_date"), 1))
    first = own.groupBy("loan_id").agg(since.alias("changed_from"))
    of_loan = Window.partitionBy("loan_id")
    since = F.greatest(F.first("changed_from").over(of_loan), F.date_add(F.min("balance_date").over(of_loan), 1))
    kept = own.withColumn("_since", since).filter(F.col("balance_date") < F.col("_since")).select(*BALANCE_COLUMNS)
    paid = daily.join(changed.select("loan_id").hint("shuffle_hash"), "loan_id", "left_semi")
    return _days(_running_balances(latest_open(kept), paid, _until(day))), first


def merge_rebuilt(balances: DataFrame, rows: DataFrame, replaced: DataFrame) -> DataFrame:
    """``balances`` with the rows that ``rebuild_changed`` gave in place of the changed loans' rows.

    Where ``balances`` are held by loan, only ``replaced`` is shuffled.
    """
    kept = balances.select(*BALANCE_COLUMNS).join(replaced.hint("shuffle_hash"), "loan_id", "left").filter(
        F.col("changed_from").isNull() | (F.col("balance_date") < F.col("changed_from"))
    )
    return kept.drop("changed_from").unionByName(rows)
