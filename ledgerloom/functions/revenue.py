"""Labels and rates of the revenue snapshot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# VAT by country id.
VAT = {12: "0.16", 22: "0.19", 24: "0.18"}

# Lateness limits in days.
PAID_LATE_LIMIT = 60
PAID_WRITE_OFF_LIMIT = 90
DEFAULT_LIMITS = (15, 30, 60, 90)
# Open statuses that age into default buckets, with the label suffix.
AGEING_STATUSES = {"DEFAULT": "", "PAUSE": "_PAUSE", "CANCELED": "_CANCELED"}


def cycle_label(financing_type: Column, loan_num: Column) -> Column:
    """FIRST / REPEAT for regular loans by ordinal, REFILL for every other type."""
    regular = F.when(loan_num == 1, F.lit("FIRST")).otherwise(F.lit("REPEAT"))
    return F.when(financing_type == "REGULAR", regular).otherwise(F.lit("REFILL"))


def vat_rate(country: Column) -> Column:
    out = F.lit(None).cast("decimal(3,2)")
    for code, rate in VAT.items():
        out = F.when(country == code, F.lit(rate).cast("decimal(3,2)")).otherwise(out)
    return out


def days_late(due: Column, paid_on: Column) -> Column:
    """Days from the due date to the last collection; negative when early."""
    return F.datediff(paid_on, due)


def npl_status(
    financing_status: Column, status: Column, due: Column, last_collection: Column, as_of: Column,
) -> Column:
    """Performance bucket: paid loans by lateness of the last collection, others by age past due.

    ``status`` is the ageing status of an unpaid loan; it may be another column than
    ``financing_status``. Unpaid loans more than 90 days past due stay 'ACTIVE', as does a paid loan
    without any collection date whose ``status`` does not age.
    """
    late = days_late(due, last_collection)
    age = F.datediff(as_of, due)
    paid = (
        F.when(late <= 0, F.lit("PAID_IN_TERM"))
        .when(late <= PAID_LATE_LIMIT, F.lit("PAID_IN_60_DAY_DEFAULT"))
        .when(late <= PAID_WRITE_OFF_LIMIT, F.lit("PAID_IN_90_DAY_DEFAULT"))
        .when(late.isNotNull(), F.lit("PAID_AFTER_WRITE-OFF"))
    )
    bucket = F.when(age <= DEFAULT_LIMITS[0], F.lit(DEFAULT_LIMITS[0]))
    for limit in DEFAULT_LIMITS[1:]:
        bucket = bucket.when(age <= limit, F.lit(limit))
    suffix = F.when(status == "DEFAULT", F.lit(AGEING_STATUSES["DEFAULT"]))
    for name in ("PAUSE", "CANCELED"):
        suffix = suffix.when(status == name, F.lit(AGEING_STATUSES[name]))
    # concat is NULL when the status does not age or the loan is past the last bucket
    ageing = F.concat(bucket.cast("string"), F.lit("_DAY_DEFAULT"), suffix)
    return F.coalesce(
        F.when(financing_status == "PAID", paid),
        ageing,
        F.when(status == "WRITE-OFF", F.lit("WRITE-OFF")),
        F.lit("ACTIVE"),
    )
