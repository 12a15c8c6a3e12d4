"""The full daily revenue snapshot, composed of the revenue operators."""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.revenue import npl_status, vat_rate
from ledgerloom.operators.revenue import (
    checked_rates, last_collection, loan_cycle, previous_day_rate, rate_table, revenue, usd_columns,
)

SNAPSHOT_COLUMNS = (
    "country_name", "country_id", "financing_id", "user_id", "external_merchant_id", "loan_num",
    "status_prod", "loan_num_status", "loan_npl_status", "loan_start_date", "last_collection_date",
    "last_collection_date_to_due_date_days", "due_date", "usd_rate_at_last_collection_date",
    "repayment_rate", "total_repayment_amount_local", "total_repayment_amount_usd", "fga_rate",
    "fga_sum_local", "fga_sum_usd", "disbursed_amount_local", "disbursed_amount_usd",
    "paid_total_local", "paid_total_usd", "fixed_fee_local", "fixed_fee_usd", "vat",
    "percent_from_fee", "revenue_local", "revenue_usd", "snap_dt_part", "parent_financing_id",
    "refill_amount",
)


def _one(df: DataFrame, key: str, value: str, as_key: str, as_value: str) -> DataFrame:
    """(key, value), one row per key; repeated rows count once, a key with two values is an error when read."""
    found = df.groupBy(F.col(key).alias(as_key)).agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    clash = F.raise_error(F.concat(F.lit(f"two values of {value} for {key} "), F.col(as_key).cast("string")))
    chosen = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_least")).otherwise(clash)
    return found.select(as_key, chosen.alias(as_value))


def revenue_snapshot(
    fin: DataFrame, drivers: DataFrame, offers: DataFrame, offers_hist: DataFrame,
    repayments: DataFrame, currency: DataFrame, as_of: str | dt_.date, project: str,
    rates: DataFrame | None = None,
) -> DataFrame:
    """One row per loan of ``project`` as of a day.

    Loans are numbered before any other table is joined. Drivers, offers and historical offers may repeat rows;
    a key with two values is an error, and so are rates of which two apply to a loan. The key of currency must be unique (``audit_unique``). Every row then
    differs by user and ordinal, so a DISTINCT over the wide result could remove nothing and is not paid for.
    """
    rates = rate_table(fin.sparkSession) if rates is None else checked_rates(rates)
    loans = loan_cycle(fin.filter(F.col("project_name") == project))
    merchant = _one(drivers, "dwh_driver_id", "driver_id", "user_id", "external_merchant_id")
    offer = _one(offers, "offer_id", "interest_amount", "offer_id", "offer_interest_amount")
    old_offer = _one(offers_hist, "offer_id", "fixed_fee", "offer_id", "offer_fixed_fee")
    joined = (
        loans.join(last_collection(repayments, project), "financing_id", "left")
        .join(offer, "offer_id", "left")
        .join(old_offer, "offer_id", "left")
        .join(merchant, "user_id", "left")
    )
    priced = usd_columns(revenue(previous_day_rate(joined, currency), rates))
    today = F.lit(str(as_of)).cast("date")
    due, last = F.col("due_date"), F.col("last_collection_date")
    computed = {
        "status_prod": F.col("financing_status"),
        "loan_npl_status": npl_status(F.col("financing_status"), F.col("status"), due, last, today),
        "loan_start_date": F.col("start_date"),
        "last_collection_date_to_due_date_days": F.datediff(due, last),
        "usd_rate_at_last_collection_date": F.col("usd_rate"),
        "total_repayment_amount_local": F.col("total_repayment_amount"),
        "fga_sum_local": F.col("fga_fee"),
        "disbursed_amount_local": F.col("disbursed_amount"),
        "paid_total_local": F.col("paid_amount"),
        "fixed_fee_local": F.col("interest_amount"),
        "vat": vat_rate(F.col("country_id")),
        "snap_dt_part": today,
    }
    return priced.withColumns(computed).select(*SNAPSHOT_COLUMNS)
