"""Payment totals by loan and day, and by billing month."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _between(payments: DataFrame, since: str | dt_.date | None, until: str | dt_.date | None) -> DataFrame:
    """Payments of the days since .. until - 1; the bounds compare with the stored timestamp and so reach the scan."""
    for bound, keep in ((since, lambda at, day: at >= day), (until, lambda at, day: at < day)):
        if bound is not None:
            payments = payments.filter(keep(F.col("payment_dttm"), F.lit(str(bound)).cast("timestamp_ntz")))
    return payments


def daily_totals(
    payments: DataFrame, since: str | dt_.date | None = None, until: str | dt_.date | None = None
) -> DataFrame:
    """Amount and number of payments, one row per loan and day.

    Combines map-side, so a hot loan shuffles one row per task and day.
    """
    return _between(payments, since, until).groupBy("loan_id", F.to_date("payment_dttm").alias("payment_dttm")).agg(
        F.sum("payment_amount").alias("daily_total_amount"), F.count(F.lit(1)).alias("payments_count")
    )


def payment_ids(
    payments: DataFrame, since: str | dt_.date | None = None, until: str | dt_.date | None = None
) -> DataFrame:
    """One row per payment: loan, day and id. Join it to totals or a report by loan and day; no list is gathered."""
    return _between(payments, since, until).select("loan_id", F.to_date("payment_dttm").alias("payment_dttm"), "id")


def payments_by_billing_month(payments: DataFrame) -> DataFrame:
    """Amount per loan and billing month, the month after the payment."""
    month = F.trunc(F.add_months("payment_date", 1), "MM")
    return payments.groupBy("loan_id", month.alias("month")).agg(
        F.sum("payment_amount").alias("total_payment_amount")
    )
