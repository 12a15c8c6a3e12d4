"""Declared schemas of the input frames as DDL strings (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOANS = (
    "id INT NOT NULL, product_id INT NOT NULL, offer_id INT NOT NULL, status STRING NOT NULL, "
    "open_dttm TIMESTAMP_NTZ NOT NULL, due_dttm TIMESTAMP_NTZ NOT NULL, close_dttm TIMESTAMP_NTZ"
)
OFFERS = "id INT NOT NULL, product_id INT, approved_amount INT NOT NULL, status STRING NOT NULL"
PRODUCTS_FLAT = (
    "id INT NOT NULL, product_name STRING NOT NULL, interest_rate INT NOT NULL, "
    "period_days INT NOT NULL, policy_id INT, risk_category STRING"
)
PRODUCTS_POLICY = (
    "id INT NOT NULL, product_name STRING NOT NULL, risk_category STRING, policy_id INT, "
    "required_fields ARRAY<STRING>"
)
PRODUCT_TERMS = (
    "id INT NOT NULL, policy_name STRING NOT NULL, status STRING NOT NULL, policy_config STRING NOT NULL"
)
# The JSON document inside product_terms.policy_config.
POLICY_CONFIG = (
    "periods INT, period_length INT, total_interest_rate INT, "
    "period_interest_rate DECIMAL(9,3), interest_on STRING"
)
PAYMENTS = (
    "id INT NOT NULL, loan_id INT, source STRING NOT NULL, payment_dttm TIMESTAMP_NTZ NOT NULL, "
    "payment_amount INT"
)
BALANCES = (
    "loan_id INT NOT NULL, balance_date DATE NOT NULL, open_principal INT NOT NULL, "
    "open_interest INT NOT NULL, open_vat INT NOT NULL, loan_balance INT NOT NULL"
)
CONTRACT_LOANS = (
    "id INT NOT NULL, amount DECIMAL(14,2) NOT NULL, interest_rate DECIMAL(5,2) NOT NULL, "
    "term_months INT NOT NULL, start_date DATE NOT NULL, status STRING"
)
CONTRACT_PAYMENTS = "loan_id INT, payment_date DATE NOT NULL, payment_amount DECIMAL(14,2) NOT NULL"
SCHEDULES = (
    "loan_id INT, version INT NOT NULL, payment_number INT NOT NULL, payment_date DATE NOT NULL, "
    "total_payment DECIMAL(14,2) NOT NULL, principal_part DECIMAL(14,2) NOT NULL, "
    "interest_part DECIMAL(14,2) NOT NULL, open_principal DECIMAL(14,2) NOT NULL, status STRING"
)
FORM_PRODUCTS = "product_id INT, product_name STRING"
WINDOWS = "window_id INT, window_name STRING, is_active BOOLEAN"
FIELDS = "field_id INT, field_name STRING, is_active BOOLEAN"
PRODUCT_WINDOWS = "product_id INT, window_id INT, display_order INT"
WINDOW_FIELDS = "window_id INT, field_id INT, display_order INT"
PATCHES = "application_id INT, seq INT, patch STRING, window_id INT, status STRING"
SOURCES = "id STRING, source_name STRING, priority INT"
ATTRIBUTE_META = "id STRING, attr_name STRING, expiration_policy INT, data_type STRING"


def with_defaults(df: DataFrame, **defaults) -> DataFrame:
    """Fill NULLs in the named columns, as a column DEFAULT would on insert."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
