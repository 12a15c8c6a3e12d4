"""Opening balances of new loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arith import int_div, to_int

YEAR_DAYS = 365
VAT_SHARE = "0.16"


def parse_terms(terms: DataFrame) -> DataFrame:
    """One row per policy with the JSON document parsed once into whole-number columns.

    Numbers may be quoted. Broken JSON is an error, and so, under ANSI, is a number that is not whole.
    """
    names = ("periods", "period_length", "total_interest_rate")
    config = F.from_json("policy_config", ", ".join(f"{c} string" for c in names), {"mode": "FAILFAST"})
    return terms.select("id", config.alias("c")).select(
        F.col("id").alias("policy_id"), *[F.col(f"c.{c}").cast("int").alias(c) for c in names]
    )


def expand_terms(terms: DataFrame) -> DataFrame:
    """Policy calendar: first three period ends and the horizon, in days from opening."""
    length, periods = F.col("period_length"), F.col("periods")
    return parse_terms(terms).select(
        "policy_id",
        "periods",
        "period_length",
        "total_interest_rate",
        (periods * length).alias("horizon_days"),
        *[(F.lit(k) * length).alias(f"period_{k}") for k in (1, 2, 3)],
    )


def _opening_columns(approved: Column, rate: Column, days: Column) -> list[Column]:
    """Interest truncates at each division; VAT is rounded to cents, then to whole units."""
    charged = int_div(approved.cast("bigint") * rate, 100) * days
    vat = F.round(F.lit(VAT_SHARE).cast("decimal(3,2)") * charged / F.lit(YEAR_DAYS), 2)
    principal = approved.cast("int")
    interest = int_div(charged, YEAR_DAYS).cast("int")
    return [
        principal.alias("open_principal"),
        interest.alias("open_interest"),
        to_int(vat).alias("open_vat"),
        (principal + interest + to_int(vat)).alias("loan_balance"),
    ]


def _active(loans: DataFrame) -> DataFrame:
    return loans.filter(F.col("status") == "ACTIVE").select(
        F.col("id").alias("loan_id"),
        F.to_date("open_dttm").alias("balance_date"),
        "product_id",
        "offer_id",
    )


def _approved(offers: DataFrame) -> DataFrame:
    return offers.select(F.col("id").alias("offer_id"), "approved_amount")


def open_balances_flat(loans: DataFrame, products: DataFrame, offers: DataFrame) -> DataFrame:
    """Opening row per ACTIVE loan of ``loans`` with rate and days from the product.

    The frame passed in is the scope: give the new batch to open only it. A loan without its offer
    keeps NULL amounts, which ``audit_not_null`` reports.
    """
    product = products.select(F.col("id").alias("product_id"), "interest_rate", "period_days")
    return (
        _active(loans)
        .join(product, "product_id")
        .join(_approved(offers), "offer_id", "left")
        .select(
            "loan_id",
            "balance_date",
            *_opening_columns(F.col("approved_amount"), F.col("interest_rate"), F.col("period_days")),
        )
    )


def open_balances_policy(
    loans: DataFrame, products: DataFrame, offers: DataFrame, terms: DataFrame
) -> DataFrame:
    """Opening row per ACTIVE loan with rate and days from the product's policy document."""
    product = products.select(F.col("id").alias("product_id"), "policy_id").join(
        parse_terms(terms), "policy_id", "left"
    )
    return (
        _active(loans)
        .join(product, "product_id")
        .join(_approved(offers), "offer_id", "left")
        .select(
            "loan_id",
            "balance_date",
            *_opening_columns(
                F.col("approved_amount"),
                F.col("total_interest_rate"),
                F.col("period_length") * F.col("periods"),
            ),
        )
    )
