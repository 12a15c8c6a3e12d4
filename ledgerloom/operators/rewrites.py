"""Upserts, cuts and conditional updates expressed as frames.

Parquet has no row-level DELETE or UPDATE, so each returns the table's new contents; write it to a
new path or by partition.
"""

from __future__ import annotations

import datetime as dt_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(value: str | dt_.date) -> Column:
    return F.lit(str(value)).cast("date")


def _instant(value: str | dt_.date) -> Column:
    """Start of a day. Compared with a stored timestamp it reaches the scan, which ``to_date`` around it does not."""
    return F.lit(str(value)).cast("timestamp_ntz")


def without_ids(df: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``ids``; NULL keys stay."""
    gone = ids.select(F.col(id_column).alias("_gone"))
    return df.join(gone, F.col(column) == F.col("_gone"), "left_anti")


def upsert_loans(loans: DataFrame, balances: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch replaces loans of the same id; their balance rows go, to be opened again."""
    kept = without_ids(loans, "id", batch)
    return kept.unionByName(batch.select(*loans.columns)), without_ids(balances, "loan_id", batch)


def upsert_payments(payments: DataFrame, staged: DataFrame, dt: str | dt_.date) -> DataFrame:
    """Staged payments of day ``dt`` replace payments of the same id."""
    on, after = F.col("payment_dttm"), dt_.date.fromisoformat(str(dt)) + dt_.timedelta(days=1)
    day = staged.filter((on >= _instant(dt)) & (on < _instant(after))).select(*payments.columns)
    return without_ids(payments, "id", day).unionByName(day)


def rebuild_payments(
    payments: DataFrame, staged: DataFrame, dt: str | dt_.date, as_of: str | dt_.date
) -> DataFrame:
    """Payments from ``dt`` on are dropped and the staged days dt .. as_of - 1 applied at once.

    Staged ids are unique, so applying the days one by one or together gives the same rows.
    """
    on = F.col("payment_dttm")
    window = staged.filter((on >= _instant(dt)) & (on < _instant(as_of))).select(*payments.columns)
    kept = payments.filter(on < _instant(dt))
    return without_ids(kept, "id", window).unionByName(window)


def set_where(df: DataFrame, cond: Column, column: str, value) -> DataFrame:
    """Conditional update of one column; rows where ``cond`` is not true keep their value."""
    value = value if isinstance(value, Column) else F.lit(value)
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(cond, value.cast(kind)).otherwise(F.col(column)))


def cut_from(
    df: DataFrame, dt: str | dt_.date, date_column: str,
    loan_id: int | None = None, loan_column: str = "loan_id",
) -> DataFrame:
    """Drop rows dated ``dt`` or later, of one loan or of all. Rows without a date or loan stay."""
    on, loan = F.col(date_column), F.col(loan_column)
    kept = (on < _day(dt)) | on.isNull()
    if loan_id is not None:
        kept = kept | (loan != F.lit(loan_id)) | loan.isNull()
    return df.filter(kept)
