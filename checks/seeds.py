"""The small product tables every binding shares, as SQL literals."""

from __future__ import annotations

PRODUCTS_FLAT = """
    (2001, 'general_loan', 22, 124, 6002, 'A'),
    (2002, 'general_loan', 24, 124, 6002, 'B'),
    (2003, 'general_loan', 26, 124, 6002, 'C'),
    (2004, 'newbies_loan', 20, 124, 6002, NULL),
    (2005, 'platinum_loan', 21, 124, 6001, NULL)
"""
PRODUCTS_FLAT_COLUMNS = "id, product_name, interest_rate, period_days, policy_id, risk_category"

PRODUCTS_POLICY = """
    (2001, 'general_loan', 'A', 6001),
    (2002, 'general_loan', 'B', 6001),
    (2003, 'general_loan', 'C', 6001),
    (2004, 'newbies_loan', NULL, 6002),
    (2005, 'platinum_loan', NULL, 6002)
"""
PRODUCTS_POLICY_COLUMNS = "id, product_name, risk_category, policy_id"

TERMS = """
    (6001, 'standard', 'ACTIVE', '{"periods": 4, "period_length": 31, "total_interest_rate": 40, "period_interest_rate": 10, "interest_on": "open_principal"}'),
    (6002, 'ultra-hard: 2d periods', 'ACTIVE', '{"periods": 62, "period_length": 2, "total_interest_rate": 40, "period_interest_rate": 0.645, "interest_on": "open_principal"}'),
    (6003, 'hard: 4d periods', 'ACTIVE', '{"periods": 31, "period_length": 4, "total_interest_rate": 40, "period_interest_rate": 1.290, "interest_on": "open_principal"}')
"""
TERMS_COLUMNS = "id, policy_name, status, policy_config"

# the same policies as plain numbers, for SQL that does not parse JSON
TERMS_FLAT = "(6001, 4, 31, 40), (6002, 62, 2, 40), (6003, 31, 4, 40)"
TERMS_FLAT_COLUMNS = "policy_id, periods, period_length, rate"
