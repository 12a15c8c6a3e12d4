"""The daily cycle: load a batch of loans, load a day's payments, roll balances, report."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.balances import BALANCE_COLUMNS, catch_up, latest_open, roll_one_day
from ledgerloom.operators.opening import open_balances_flat, open_balances_policy
from ledgerloom.operators.payments import daily_totals
from ledgerloom.operators.rewrites import upsert_loans


def _opened(loans, balances, batch, reopen_all, opener) -> tuple[DataFrame, DataFrame]:
    loans, kept = upsert_loans(loans, balances, batch)
    rows = opener(loans if reopen_all else batch)
    return loans, kept.select(*BALANCE_COLUMNS).unionByName(rows)


def add_loans_flat(
    loans: DataFrame, balances: DataFrame, batch: DataFrame, products: DataFrame, offers: DataFrame,
    reopen_all: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Upsert a batch and open its balances with flat products.

    ``reopen_all`` opens every ACTIVE loan of the merged table again, not only the batch.
    """
    return _opened(loans, balances, batch, reopen_all, lambda s: open_balances_flat(s, products, offers))


def add_loans_policy(
    loans: DataFrame, balances: DataFrame, batch: DataFrame, products: DataFrame, offers: DataFrame,
    terms: DataFrame, reopen_all: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Upsert a batch and open its balances with policy products."""
    return _opened(
        loans, balances, batch, reopen_all, lambda s: open_balances_policy(s, products, offers, terms)
    )


def close_one_day(balances: DataFrame, payments: DataFrame, day: str | dt_.date) -> DataFrame:
    """The rows of ``day`` alone: balances of the day before, rolled by the payments of ``day``.

    Both scans are pruned, to one partition and one day. Loans whose newest row is older are not caught up;
    ``catch_up_day`` does that.
    """
    closing = dt_.date.fromisoformat(str(day))
    before = balances.filter(F.col("balance_date") == F.lit(str(closing - dt_.timedelta(days=1))).cast("date"))
    return roll_one_day(before, daily_totals(payments, closing, closing + dt_.timedelta(days=1)))


def close_day(balances: DataFrame, payments: DataFrame) -> DataFrame:
    """Balance history with one more day per open loan.

    Write the result before closing the next day; for many days at once use ``rebuild_balances``,
    which needs one pass however many days there are.
    """
    rolled = roll_one_day(balances, daily_totals(payments))
    return balances.select(*BALANCE_COLUMNS).unionByName(rolled)


def catch_up_day(balances: DataFrame, payments: DataFrame, day: str | dt_.date) -> DataFrame:
    """The missing rows of all open loans through ``day``, each from its own newest row on.

    One small job finds the oldest of the newest rows; payments before it are not read. Loans that are up to date cost
    nothing beyond reading their newest row.
    """
    closing = dt_.date.fromisoformat(str(day))
    behind = latest_open(balances).filter(F.col("balance_date") < F.lit(str(closing)).cast("date"))
    oldest = behind.agg(F.min("balance_date")).first()[0]
    if oldest is None:
        return balances.select(*BALANCE_COLUMNS).limit(0)
    daily = daily_totals(payments, oldest + dt_.timedelta(days=1), closing + dt_.timedelta(days=1))
    return catch_up(balances, daily, closing)
