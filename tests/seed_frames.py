"""The seed rows behind the golden cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from checks import seeds
from ledgerloom import schemas


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark: SparkSession, rows, schema: str):
    return spark.createDataFrame(list(rows), schema)


def products_flat(spark):
    return spark.sql(f"SELECT * FROM VALUES {seeds.PRODUCTS_FLAT} AS t({seeds.PRODUCTS_FLAT_COLUMNS})")


def products_policy(spark):
    return spark.sql(f"SELECT * FROM VALUES {seeds.PRODUCTS_POLICY} AS t({seeds.PRODUCTS_POLICY_COLUMNS})")


def terms(spark):
    return spark.sql(f"SELECT * FROM VALUES {seeds.TERMS} AS t({seeds.TERMS_COLUMNS})")


def offers(spark):
    return frame(spark, [(7001, 2001, 16000, "ACTIVE"), (7002, 2001, 12000, "EXPIRED")], schemas.OFFERS)


def loans(spark):
    rows = [(3001, 2001, 7001, "ACTIVE", at("2025-03-17 10:00:00"), at("2025-07-20 10:00:00"), None)]
    return frame(spark, rows, schemas.LOANS)


def old_loans(spark):
    rows = [(3004, 2001, 7002, "PAID", at("2024-10-04 18:00:00"), at("2025-03-08 18:00:00"), at("2025-03-08 16:00:00"))]
    return frame(spark, rows, schemas.LOANS)


def old_balances(spark):
    return frame(spark, [(3004, day("2025-03-08"), 0, 0, 0, 0)], schemas.BALANCES)


def payments(spark, rows):
    return frame(
        spark, [(i, loan, source, at(when), amount) for i, loan, source, when, amount in rows], schemas.PAYMENTS
    )


WALKTHROUGH = [
    (4100, 3001, "ride_payment", "2025-03-18 11:00:00", 700),
    (4101, 3001, "ride_payment", "2025-03-18 11:30:00", 800),
    (4102, 3001, "ride_payment", "2025-03-18 14:00:00", 1100),
    (4106, 3001, "ride_payment", "2025-03-19 22:30:00", 1800),
    (4107, 3001, "ride_payment", "2025-03-20 12:20:00", 1150),
    (4108, 3001, "direct_payment", "2025-03-20 18:10:00", 2000),
    (4109, 3001, "direct_payment", "2025-03-22 18:10:00", 8450),
]

DELINQUENT = [
    (4100, 3001, "ride_payment", "2025-03-18 11:00:00", 700),
    (4106, 3001, "ride_payment", "2025-03-19 22:30:00", 300),
    (4107, 3001, "ride_payment", "2025-03-20 12:20:00", 400),
    (4108, 3001, "direct_payment", "2025-03-20 18:10:00", 550),
    (4109, 3001, "direct_payment", "2025-03-22 18:10:00", 200),
    (4111, 3001, "ride_payment", "2025-03-23 22:30:00", 300),
    (4112, 3001, "ride_payment", "2025-03-24 12:20:00", 400),
    (4113, 3001, "ride_payment", "2025-03-25 22:30:00", 220),
    (4114, 3001, "ride_payment", "2025-03-26 12:20:00", 150),
    (4115, 3001, "ride_payment", "2025-03-25 22:30:00", 180),
    (4116, 3001, "ride_payment", "2025-03-26 12:20:00", 100),
    (4117, 3001, "ride_payment", "2025-03-28 12:20:00", 380),
    (4118, 3001, "ride_payment", "2025-03-29 22:30:00", 700),
    (4119, 3001, "ride_payment", "2025-03-30 12:20:00", 550),
]

CONTRACTS = [
    (1, Decimal("2000.00"), Decimal("10.00"), 4, day("2025-01-01"), "active"),
    (2, Decimal("2000.00"), Decimal("16.00"), 4, day("2025-01-01"), "active"),
    (3, Decimal("2000.00"), Decimal("10.00"), 8, day("2025-01-01"), "active"),
]


def contracts(spark, rows=CONTRACTS):
    return frame(spark, rows, schemas.CONTRACT_LOANS)


def contract_payments(spark, rows):
    return frame(spark, [(loan, day(d), Decimal(a)) for loan, d, a in rows], schemas.CONTRACT_PAYMENTS)


EXACT = [
    (1, "2025-01-15", "630.94"), (1, "2025-02-05", "200.00"), (1, "2025-02-18", "300.94"), (1, "2025-02-25", "130.00"),
    (1, "2025-03-10", "400.00"), (1, "2025-03-22", "230.94"), (1, "2025-04-03", "150.00"), (1, "2025-04-12", "180.00"),
    (1, "2025-04-20", "200.95"), (1, "2025-04-29", "100.00"),
]
OVER = [(1, "2025-01-15", "630.94"), (1, "2025-02-05", "930.94")]
EARLY = [(1, "2025-01-15", "630.94"), (1, "2025-02-05", "1725.97")]
UNDER = [(1, "2025-01-15", "300.94"), (1, "2025-02-05", "400.94")]
THIRD = [(3, "2025-01-12", "374.89"), (3, "2025-02-05", "1200.00")]
