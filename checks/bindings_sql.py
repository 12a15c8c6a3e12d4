"""The frames of ``bindings.py`` as DuckDB CTEs over the test tables."""

from __future__ import annotations

import re

from checks import seeds
from checks.bindings import PROJECT

_OPENED = "DATE '2025-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 90 AS INT)"

CTES = {
    "products_flat": f"SELECT * FROM (VALUES {seeds.PRODUCTS_FLAT}) t({seeds.PRODUCTS_FLAT_COLUMNS})",
    "products_policy": f"SELECT * FROM (VALUES {seeds.PRODUCTS_POLICY}) t({seeds.PRODUCTS_POLICY_COLUMNS})",
    "terms": f"SELECT * FROM (VALUES {seeds.TERMS_FLAT}) t({seeds.TERMS_FLAT_COLUMNS})",
    "loans": f"""
        SELECT o_orderkey AS id, CAST(2001 + o_custkey % 5 AS INT) AS product_id, o_orderkey AS offer_id,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'PAID' ELSE 'DEFAULT' END AS status,
               CAST({_OPENED} AS TIMESTAMP) AS open_dttm,
               CAST({_OPENED} + 124 AS TIMESTAMP) AS due_dttm,
               CAST(NULL AS TIMESTAMP) AS close_dttm
        FROM orders""",
    "loan_batch": """
        SELECT l.* REPLACE ('ACTIVE' AS status) FROM loans l
        WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "offers": """
        SELECT o_orderkey AS id, CAST(2001 + o_custkey % 5 AS INT) AS product_id,
               CAST(floor(o_totalprice) AS INT) AS approved_amount,
               CASE WHEN o_orderstatus = 'O' THEN 'ACTIVE' ELSE 'EXPIRED' END AS status
        FROM orders""",
    "low_offers": """
        SELECT * FROM offers WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW')""",
    "payment_rows": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey AS loan_id,
               CASE WHEN l_returnflag = 'N' THEN 'ride_payment' ELSE 'direct_payment' END AS source,
               CAST({_OPENED} + CAST(l_partkey % 120 + 1 AS INT) AS TIMESTAMP)
                   + to_minutes(CAST(l_suppkey % 1440 AS INT)) AS payment_dttm,
               CAST(floor(l_extendedprice / 4) AS INT) AS payment_amount, l_returnflag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "payments": "SELECT * EXCLUDE (l_returnflag) FROM payment_rows",
    "settled": "SELECT * EXCLUDE (l_returnflag) FROM payment_rows WHERE l_returnflag <> 'R'",
    "staged": """
        SELECT * EXCLUDE (l_returnflag) REPLACE (payment_amount + 1 AS payment_amount)
        FROM payment_rows WHERE l_returnflag <> 'N'""",
    "daily": """
        SELECT loan_id, CAST(payment_dttm AS DATE) AS payment_dttm,
               CAST(sum(payment_amount) AS BIGINT) AS daily_total_amount,
               count(*) AS payments_count
        FROM payments GROUP BY ALL""",
    # opening amounts in exact arithmetic on the loan's rate and days
    "opened_flat": """
        SELECT l.id AS loan_id, CAST(l.open_dttm AS DATE) AS balance_date, o.approved_amount AS a,
               (CAST(o.approved_amount AS BIGINT) * p.interest_rate // 100) * p.period_days AS x
        FROM loans l JOIN products_flat p ON p.id = l.product_id LEFT JOIN offers o ON o.id = l.offer_id
        WHERE l.status = 'ACTIVE'""",
    "opened_policy": """
        SELECT l.id AS loan_id, CAST(l.open_dttm AS DATE) AS balance_date, o.approved_amount AS a,
               (CAST(o.approved_amount AS BIGINT) * t.rate // 100) * t.periods * t.period_length AS x
        FROM loans l JOIN products_policy p ON p.id = l.product_id
        LEFT JOIN terms t ON t.policy_id = p.policy_id LEFT JOIN offers o ON o.id = l.offer_id
        WHERE l.status = 'ACTIVE'""",
    "flat_balances": "SELECT loan_id, balance_date, {amounts} FROM opened_flat",
    "policy_balances": "SELECT loan_id, balance_date, {amounts} FROM opened_policy",
    "contract_loans": """
        SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(14,2)) AS amount,
               CAST(CASE WHEN o_custkey % 2 = 0 THEN 10 ELSE 16 END AS DECIMAL(5,2)) AS interest_rate,
               CASE WHEN o_custkey % 4 < 2 THEN 4 ELSE 8 END AS term_months,
               CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderstatus = 'P' THEN 'overdue' ELSE 'active' END AS status
        FROM orders""",
    "contract_payments": """
        SELECT l_orderkey AS loan_id, CAST(o_orderdate AS DATE) + CAST(l_partkey % 150 AS INT) AS payment_date,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS payment_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fin": f"""
        SELECT *, CASE WHEN financing_type = 'REFILL' THEN financing_id - 1 END AS parent_financing_id,
               CASE WHEN financing_type = 'REFILL' THEN interest_amount END AS refill_amount,
               financing_status AS status,
               CAST(disbursed_amount + interest_amount AS DECIMAL(14,2)) AS total_repayment_amount,
               CAST(CASE WHEN financing_status = 'PAID' THEN disbursed_amount + interest_amount ELSE 0 END
                    AS DECIMAL(14,2)) AS paid_amount
        FROM (
            SELECT *, CAST(round(disbursed_amount * 0.10, 2) AS DECIMAL(14,2)) AS interest_amount,
                   CAST(round(disbursed_amount * 0.02, 2) AS DECIMAL(14,2)) AS fga_fee,
                   'country_' || country_id AS country_name
            FROM (
                SELECT o_orderkey AS financing_id, o_custkey * 4 + o_orderkey % 4 AS user_id,
                       CASE n_regionkey WHEN 0 THEN 12 WHEN 1 THEN 22 WHEN 2 THEN 24 ELSE 99 END AS country_id,
                       o_orderkey AS offer_id,
                       CASE WHEN o_orderpriority = '5-LOW' THEN 'OTHER' ELSE '{PROJECT}' END AS project_name,
                       CASE WHEN o_orderstatus = 'F' THEN 'PAID' WHEN o_orderstatus = 'O' THEN 'DEFAULT'
                            WHEN o_orderkey % 3 = 0 THEN 'PAUSE' WHEN o_orderkey % 3 = 1 THEN 'CANCELED'
                            ELSE 'WRITE-OFF' END AS financing_status,
                       CASE (o_orderkey // 4) % 4 WHEN 2 THEN 'REFILL' WHEN 3 THEN 'regular' ELSE 'REGULAR' END
                           AS financing_type,
                       CAST(o_orderdate AS DATE) + 9000 AS start_date,
                       CAST(o_orderdate AS DATE) + 9124 AS due_date,
                       CAST(o_orderkey % 20 + 10 AS INT) AS repayment_rate,
                       CAST(o_totalprice AS DECIMAL(14,2)) AS disbursed_amount
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))""",
    "drivers": """
        SELECT DISTINCT o_custkey * 4 + o_orderkey % 4 AS dwh_driver_id,
               o_custkey * 4 + o_orderkey % 4 + 1000000 AS driver_id
        FROM orders""",
    "fee_offers": """
        SELECT o_orderkey AS offer_id,
               CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 0.12, 2) AS DECIMAL(14,2)) AS interest_amount
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "historical_offers": """
        SELECT o_orderkey AS offer_id,
               CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 0.11, 2) AS DECIMAL(14,2)) AS fixed_fee
        FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')""",
    "collections": f"""
        SELECT l_orderkey AS financing_id,
               CAST(CAST(o_orderdate AS DATE) + CAST(9000 + l_partkey % 260 AS INT) AS TIMESTAMP)
                   + to_minutes(CAST(l_suppkey % 1440 AS INT)) AS repayment_created_at,
               CASE WHEN l_returnflag = 'N' THEN 'OTHER' ELSE '{PROJECT}' END AS project_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "currency": """
        SELECT country_id, d AS currency_dt_part, CAST(100 + (n * 7 + country_id) % 100 AS DOUBLE) / 100 AS usd_rate
        FROM (SELECT CAST(g AS DATE) AS d, date_diff('day', DATE '1970-01-01', CAST(g AS DATE)) AS n
              FROM generate_series(DATE '2019-08-01', DATE '2027-01-01', INTERVAL 1 DAY) s(g)),
             (VALUES (12), (22), (24), (99)) c(country_id)
        WHERE strftime(d, '%m-%d') <> '01-01'""",
    "newest_collection": f"""
        SELECT financing_id, CAST(max(repayment_created_at) AS DATE) AS last_collection_date
        FROM collections WHERE project_name = '{PROJECT}' GROUP BY financing_id""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date, md5(CAST(financing_id AS VARCHAR))) AS loan_num
        FROM fin""",
    # one row per loan with its lateness, rate and offer; project filter first, as numbering depends on it
    "priced": f"""
        SELECT f.*, n.last_collection_date, c.usd_rate,
               date_diff('day', f.due_date, n.last_collection_date) AS late,
               o.interest_amount AS offer_interest_amount, h.fixed_fee AS offer_fixed_fee
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date, md5(CAST(financing_id AS VARCHAR))) AS loan_num
              FROM fin WHERE project_name = '{PROJECT}') f
        LEFT JOIN newest_collection n USING (financing_id)
        LEFT JOIN fee_offers o ON o.offer_id = f.offer_id
        LEFT JOIN historical_offers h ON h.offer_id = f.offer_id
        LEFT JOIN currency c ON c.country_id = f.country_id AND c.currency_dt_part =
            CASE WHEN n.last_collection_date IS NULL THEN f.start_date ELSE n.last_collection_date END - 1""",
    # the agreed base percent and the share of it that lateness leaves
    "shared": """
        SELECT *, CASE
                 WHEN financing_status <> 'PAID' OR late IS NULL OR late > 90 THEN 0
                 WHEN start_date >= DATE '2024-08-01' THEN CASE WHEN country_id <> 99 THEN 7.5 ELSE 0 END
                 WHEN country_id = 12 AND loan_num = 1 THEN CASE WHEN financing_type <> 'REFILL' THEN 7 ELSE 0 END
                 WHEN country_id = 12 THEN CASE WHEN start_date < DATE '2023-12-01' THEN 10 ELSE 7.5 END
                 WHEN country_id = 22 AND start_date >= DATE '2023-12-01' THEN
                     CASE WHEN loan_num > 1 THEN 6 WHEN financing_type <> 'REFILL' THEN 5.5 ELSE 0 END
                 ELSE 0 END AS base_percent,
               CASE WHEN late <= 0 THEN 1 WHEN late <= 60 THEN 0.3 ELSE 0.15 END AS late_share
        FROM priced""",
    "earned": """
        SELECT *, CAST(CAST(base_percent * late_share AS DECIMAL(9,4)) AS DOUBLE) AS percent_from_fee FROM shared""",
    "revenues": """
        SELECT *, CASE
                 WHEN percent_from_fee = 0 THEN 0::DOUBLE
                 WHEN country_id = 24 THEN
                     CAST(coalesce(offer_interest_amount, offer_fixed_fee) AS DOUBLE) * (percent_from_fee / 100.0::DOUBLE)
                 ELSE CAST(interest_amount AS DOUBLE) * (percent_from_fee / 100.0::DOUBLE) * 100
                      / CASE country_id WHEN 12 THEN 116 ELSE 119 END
               END AS revenue_local
        FROM earned""",
    "patches": """
        SELECT user_id AS application_id, ts AS seq, event_type, regexp_extract(props, '([0-9]+)', 1) AS value,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END AS window_id,
               CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'signup' THEN 'IN_PROGRESS' END AS status
        FROM events""",
    "patch_keys": """
        SELECT application_id, seq, event_type AS key, value FROM patches
        UNION ALL SELECT application_id, seq, 'newest', event_type FROM patches""",
    "typed_keys": """
        SELECT user_id AS application_id, ts AS seq, event_type AS key,
               CASE event_type WHEN 'view' THEN n WHEN 'click' THEN '"' || n || '"'
                    WHEN 'purchase' THEN CASE WHEN CAST(n AS INT) % 2 = 0 THEN 'true' ELSE 'false' END
                    WHEN 'signup' THEN '{"at":{"n":' || n || '},"tags":["a",' || n || ',null]}' ELSE 'null' END AS value
        FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS n FROM events)
        UNION ALL SELECT user_id, ts, 'newest', '{"kind":"' || event_type || '"}' FROM events""",
    "incoming": """
        SELECT CASE event_type WHEN 'purchase' THEN 'partner_API' WHEN 'error' THEN 'unlisted' ELSE 'service_db' END
                   AS source_name,
               CAST(user_id AS VARCHAR) AS user_id, event_type AS attr_name,
               regexp_extract(props, '([0-9]+)', 1) AS value, ts AS created_at
        FROM events""",
    "sources": """
        SELECT md5(source_name) AS id, source_name, priority
        FROM (VALUES ('service_db', 1), ('partner_API', 2)) t(source_name, priority)""",
    "attribute_meta": """
        SELECT DISTINCT md5(event_type) AS id, event_type AS attr_name,
               CAST(length(event_type) * 30 AS INT) AS expiration_policy, 'string' AS data_type
        FROM events""",
    "attributes": """
        SELECT sha256(concat_ws('|', s.id, i.user_id, m.id, CAST(i.created_at AS VARCHAR))) AS id,
               s.id AS source_id, i.user_id, i.attr_name, m.id AS attr_meta_id, hex(encode(i.value)) AS data_hex,
               i.created_at, i.created_at AS updated_at
        FROM incoming i JOIN sources s USING (source_name) JOIN attribute_meta m USING (attr_name)""",
}

# VAT of 16 % in cents, then in whole units, both rounded half up in integers
_VAT = "((32 * x + 365) // 730 + 50) // 100"
_AMOUNTS = f"""a AS open_principal, CAST(x // 365 AS INT) AS open_interest, CAST({_VAT} AS INT) AS open_vat,
               CAST(a + x // 365 + {_VAT} AS INT) AS loan_balance"""
for _name in ("flat_balances", "policy_balances"):
    CTES[_name] = CTES[_name].format(amounts=_AMOUNTS)


def _needed(sql: str, found: dict[str, str]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found[name] = body


def with_ctes(query: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``query`` preceded by the bindings it names and by its own ``extra`` CTEs."""
    extra = extra or {}
    found: dict[str, str] = {}
    _needed(query + " ".join(extra.values()), found)
    parts = {k: v for k, v in found.items() if k not in extra} | extra
    if not parts:
        return query
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{query}"
