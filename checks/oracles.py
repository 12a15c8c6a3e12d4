"""Independent DuckDB SQL for each query of the catalogue.

Histories and schedules are stepped day by day or period by period in recursive CTEs, where the
library uses running sums and folds.
"""

from __future__ import annotations

from checks import catalog as c
from checks.bindings import PROJECT
from checks.bindings_sql import with_ctes

BALANCE = "loan_id, balance_date, open_principal, open_interest, open_vat, loan_balance"


def _date(text: str) -> str:
    return f"DATE '{text}'"


def _step(source: str, condition: str = "TRUE", more: str = "") -> str:
    """One waterfall day on the rows of ``source``: overflow of each part passes to the next."""
    return f"""
        SELECT loan_id, balance_date + 1 AS balance_date,
               CAST(open_principal - greatest(coalesce(p, 0) - open_vat - open_interest, 0) AS INT) AS open_principal,
               CAST(greatest(open_interest - greatest(coalesce(p, 0) - open_vat, 0), 0) AS INT) AS open_interest,
               CAST(greatest(open_vat - coalesce(p, 0), 0) AS INT) AS open_vat,
               CAST(loan_balance - coalesce(p, 0) AS INT) AS loan_balance{more}
        FROM (SELECT b.*, d.daily_total_amount AS p FROM {source} b
              LEFT JOIN daily d ON d.loan_id = b.loan_id AND d.payment_dttm = b.balance_date + 1)
        WHERE loan_balance <> 0 AND {condition}"""


def _rolled(opened: str, start: str, end: str) -> dict[str, str]:
    """CTEs ``kept`` and ``walk``: rows before ``start`` and the days rolled from them."""
    return {
        "kept": f"SELECT {BALANCE} FROM {opened} WHERE balance_date < {_date(start)}",
        "walk": f"""
            SELECT k.*, 0 AS n FROM kept k
            UNION ALL
            {_step('walk', f"n < date_diff('day', {_date(start)}, {_date(end)})", ", n + 1 AS n")}""",
    }


def _caught_up(opened: str, end: str) -> dict[str, str]:
    """CTE ``walk``: the rows of ``opened`` and the days rolled from each loan's newest one up to ``end``."""
    return {
        "newest": f"SELECT * FROM {opened} QUALIFY balance_date = max(balance_date) OVER (PARTITION BY loan_id)",
        "rolled": f"""
            SELECT {BALANCE} FROM newest
            UNION ALL
            {_step('rolled', f"balance_date < {_date(end)}")}""",
        "walk": f"""
            SELECT {BALANCE} FROM {opened} ANTI JOIN newest USING (loan_id, balance_date)
            UNION ALL SELECT {BALANCE} FROM rolled""",
    }


def _ladder(step: str, day: str = "day", balance: str = "balance") -> tuple[str, str]:
    """Collection status and label from the columns opened, length, periods and approved."""
    late = f"date_diff('day', opened, {day})"
    highest = f"""CASE WHEN {late} > periods * length AND {balance} > 0 THEN 4
        ELSE coalesce(list_max([k FOR k IN [1, 2, 3]
            IF {late} > k * length AND {balance} > trunc(approved * (100 - k * {step}) / 100)]), 0) END"""
    status = f"['OK', 'WARNING:1', 'WARNING:2', 'WARNING:3', 'WARNING:DPD'][{highest} + 1]"
    label = f"""CASE {highest} WHEN 0 THEN 'OK'
        ELSE ['P1: ', 'P2: ', 'P3: ', 'Last: '][{highest}] || CAST({late} - least({highest}, 3) * length AS VARCHAR) END"""
    return status, label


def _loan_status(balance: str) -> str:
    return f"CASE WHEN {balance} > 0 THEN status WHEN {balance} IS NULL THEN 'NO BALANCE DATA' ELSE 'PAID' END"


def _report(opened: str, products: str, policy: str, step: str) -> str:
    status, label = _ladder(step, "report_dt", "loan_balance")
    extra = {
        **_caught_up(opened, c.HISTORY_TO),
        "facts": f"""
            SELECT CAST(g AS DATE) AS report_dt, l.id AS loan_id, p.product_name, l.status,
                   CAST(l.open_dttm AS DATE) AS opened, t.periods, t.period_length AS length,
                   o.approved_amount AS approved, w.loan_balance, w.open_principal, w.open_interest, w.open_vat,
                   d.daily_total_amount, d.payments_count
            FROM loans l
            CROSS JOIN generate_series({_date(c.REPORT_START)}, {_date(c.REPORT_END)}, INTERVAL 1 DAY) s(g)
            LEFT JOIN {products} p ON p.id = l.product_id
            LEFT JOIN terms t ON t.policy_id = {policy}
            LEFT JOIN offers o ON o.id = l.offer_id
            LEFT JOIN walk w ON w.loan_id = l.id AND w.balance_date = CAST(g AS DATE)
            LEFT JOIN daily d ON d.loan_id = l.id AND d.payment_dttm = CAST(g AS DATE)
            WHERE CAST(g AS DATE) >= CAST(l.open_dttm AS DATE)""",
    }
    body = f"""
        SELECT report_dt, loan_id, product_name, {_loan_status('loan_balance')} AS loan_status,
               {status} AS collection_status, {label} AS dpd_status, loan_balance, open_principal, open_interest,
               open_vat, daily_total_amount, payments_count
        FROM facts"""
    return with_ctes(body, extra, recursive=True)


# general loans on the 4-day policy
_MOVED = "CASE WHEN p.product_name = 'general_loan' THEN 6003 ELSE p.policy_id END"


_REPORT = """report_dt, loan_id, product_name, loan_status, collection_status, dpd_status, loan_balance, open_principal,
    open_interest, open_vat, daily_total_amount, payments_count"""


def _as_spans() -> str:
    """Runs of days of the daily report on which nothing changes but the number of days past due."""
    values = _REPORT.replace("report_dt, loan_id, ", "").replace("dpd_status", "dpd_rung, dpd_since").replace("\n", "")
    return f"""
        SELECT loan_id, min(report_dt) AS valid_from, max(report_dt) AS valid_to, {values}
        FROM (SELECT *, report_dt - CAST(row_number() OVER (PARTITION BY loan_id, {values} ORDER BY report_dt) AS INT) AS run
              FROM (SELECT *, split_part(dpd_status, ': ', 1) AS dpd_rung,
                           report_dt - try_cast(split_part(dpd_status, ': ', 2) AS INT) AS dpd_since
                    FROM ({_flagship()})))
        GROUP BY loan_id, run, {values}"""


def _flagship() -> str:
    # 40 % over 124 days in each policy, so the opening amounts are those of policy_balances
    return _report("policy_balances", "products_policy", _MOVED, "(100 // periods)")


def _annuity(principal: str, rate: str, n: str) -> str:
    """Level payment in doubles, for terms so long that no exact half cent occurs."""
    p, r = f"CAST({principal} AS DOUBLE)", f"CAST({rate} AS DOUBLE)"
    return f"CAST(round({p} * {r} * pow(1 + {r}, {n}) / (pow(1 + {r}, {n}) - 1), 2) AS DECIMAL(14,2))"


# (100 + percent)^m and 100^m as whole numbers
_GROWTH = "SELECT * FROM (VALUES {}) t(percent, m, grown, ground)".format(
    ", ".join(
        f"({percent}, {m}, {(100 + percent) ** m}::HUGEINT, {100 ** m}::HUGEINT)"
        for percent in (10, 16) for m in range(1, 9)
    )
)


def _level(principal: str, g: str) -> str:
    """Level payment rounded half up in whole numbers; ``g`` is a row of the growth table."""
    cents = f"CAST({principal} * 100 AS HUGEINT)"
    gain = f"({g}.grown - {g}.ground)"
    return f"""CAST(CASE WHEN {principal} <= 0 THEN 0
        ELSE CAST((2 * {cents} * {g}.percent * {g}.grown + 100 * {gain}) // (200 * {gain}) AS DECIMAL(16,0)) * 0.01
        END AS DECIMAL(14,2))"""


def _even(principal: str, n: str) -> str:
    return f"""CAST(CAST((CAST({principal} * 200 AS BIGINT) + {n}) // (2 * {n}) AS DECIMAL(16,0)) * 0.01
        AS DECIMAL(14,2))"""


def _due(start: str, i: str) -> str:
    return f"CAST({start} + to_months(CAST({i} AS INT)) AS DATE)"


def _forecast(where: str) -> dict[str, str]:
    cents = "CAST(round({} , 2) AS DECIMAL(14,2))"
    return {
        "growth": _GROWTH,
        "plan": f"""
            SELECT id, start_date, term_months AS n, CAST(interest_rate / 100 AS DECIMAL(14,8)) AS r, amount,
                   {_level('amount', 'g')} AS level
            FROM contract_loans JOIN growth g ON g.percent = interest_rate AND g.m = term_months WHERE {where}""",
        "forecast": f"""
            SELECT id, 0 AS i, amount AS balance, CAST(0 AS DECIMAL(14,2)) AS principal,
                   CAST(0 AS DECIMAL(14,2)) AS interest
            FROM plan
            UNION ALL
            SELECT id, i, CAST(balance - principal AS DECIMAL(14,2)), principal, interest
            FROM (
                SELECT id, i, balance, interest,
                       CAST(CASE WHEN i = n THEN balance ELSE level - interest END AS DECIMAL(14,2)) AS principal
                FROM (SELECT f.id, f.i + 1 AS i, f.balance, p.n, p.level,
                             {cents.format('f.balance * p.r')} AS interest
                      FROM forecast f JOIN plan p USING (id) WHERE f.i < p.n))""",
        "forecast_rows": f"""
            SELECT id AS loan_id, 1 AS version, i AS payment_number, {_due('start_date', 'i')} AS payment_date,
                   CAST(principal + interest AS DECIMAL(14,2)) AS total_payment, principal AS principal_part,
                   interest AS interest_part, balance AS open_principal, 'scheduled' AS status
            FROM forecast JOIN plan USING (id) WHERE i > 0""",
    }


def _recalculated() -> dict[str, str]:
    cents = "CAST(round({} , 2) AS DECIMAL(14,2))"
    return {
        "growth": _GROWTH,
        "periods": f"""
            SELECT id, CAST(g AS INT) AS i, {_due('start_date', 'g - 1')} AS after, {_due('start_date', 'g')} AS due
            FROM contract_loans, LATERAL (SELECT unnest(range(1, term_months + 1)) AS g)""",
        "paid": """
            SELECT id, i, CAST(sum(payment_amount) AS DECIMAL(14,2)) AS paid
            FROM periods JOIN contract_payments ON loan_id = id AND payment_date > after AND payment_date <= due
            GROUP BY id, i""",
        "basis": """
            SELECT id, start_date, term_months AS n, CAST(interest_rate / 100 AS DECIMAL(14,8)) AS r, amount, status,
                   interest_rate
            FROM contract_loans""",
        "recalc": f"""
            SELECT id, 0 AS i, amount AS balance, FALSE AS projecting, CAST(0 AS DECIMAL(14,2)) AS level,
                   CAST(0 AS DECIMAL(14,2)) AS total, CAST(0 AS DECIMAL(14,2)) AS principal,
                   CAST(0 AS DECIMAL(14,2)) AS interest
            FROM basis
            UNION ALL
            SELECT id, i, CAST(balance - principal AS DECIMAL(14,2)), paid IS NULL, level,
                   CAST(coalesce(paid, principal + part) AS DECIMAL(14,2)), principal, part
            FROM (
                SELECT id, i, balance, paid, level, part,
                       CAST(least(CASE WHEN paid IS NOT NULL THEN paid - part
                                       WHEN i = n THEN balance ELSE level - part END,
                                  balance) AS DECIMAL(14,2)) AS principal
                FROM (
                    SELECT id, i, balance, paid, n, level,
                           CAST(CASE WHEN paid IS NOT NULL THEN least(paid, interest)
                                     WHEN balance <= 0 THEN 0 ELSE interest END AS DECIMAL(14,2)) AS part
                    FROM (
                        SELECT q.id, q.i + 1 AS i, q.balance, d.paid, b.n,
                               {cents.format('q.balance * b.r')} AS interest,
                               CASE WHEN d.paid IS NOT NULL OR q.projecting THEN q.level
                                    ELSE {_level('q.balance', 'g')} END AS level
                        FROM recalc q JOIN basis b USING (id)
                        JOIN growth g ON g.percent = b.interest_rate AND g.m = b.n - q.i
                        LEFT JOIN paid d ON d.id = q.id AND d.i = q.i + 1
                        WHERE q.i < b.n)))""",
        "recalc_rows": f"""
            SELECT q.id AS loan_id, CASE WHEN b.status = 'active' THEN 2 ELSE 1 END AS version, i AS payment_number,
                   {_due('start_date', 'i')} AS payment_date, total AS total_payment, principal AS principal_part,
                   interest AS interest_part, balance AS open_principal,
                   CASE WHEN projecting THEN 'scheduled' ELSE 'actual' END AS status
            FROM recalc q JOIN basis b USING (id) WHERE i > 0""",
    }


_REFRESHED = f"""
    SELECT l.id, l.amount, l.interest_rate, l.term_months, l.start_date,
           CASE WHEN r.open_principal <= 0 THEN 'closed'
                WHEN r.payment_date < {_date(c.REFRESH_DAY)} THEN 'overdue' ELSE l.status END AS status
    FROM contract_loans l
    JOIN recalc_rows r ON r.loan_id = l.id AND r.payment_number = l.term_months"""


def _versions(query: str) -> str:
    extra = {
        **_forecast("status = 'active'"),
        **_recalculated(),
        "versions": "SELECT * FROM forecast_rows UNION ALL SELECT * FROM recalc_rows",
    }
    return with_ctes(query, extra, recursive=True)


_NPL = f"""CASE
    WHEN financing_status = 'PAID' AND late IS NOT NULL THEN
        CASE WHEN late <= 0 THEN 'PAID_IN_TERM' WHEN late > 90 THEN 'PAID_AFTER_WRITE-OFF'
             ELSE 'PAID_IN_' || CASE WHEN late > 60 THEN '90' ELSE '60' END || '_DAY_DEFAULT' END
    WHEN status IN ('DEFAULT', 'PAUSE', 'CANCELED') AND due_date >= {_date(c.AS_OF)} - 90 THEN
        CASE WHEN due_date >= {_date(c.AS_OF)} - 15 THEN '15' WHEN due_date >= {_date(c.AS_OF)} - 30 THEN '30'
             WHEN due_date >= {_date(c.AS_OF)} - 60 THEN '60' ELSE '90' END
        || '_DAY_DEFAULT' || CASE status WHEN 'DEFAULT' THEN '' ELSE '_' || status END
    WHEN status = 'WRITE-OFF' THEN status
    ELSE 'ACTIVE' END"""

_CYCLE = """CASE WHEN financing_type <> 'REGULAR' THEN 'REFILL' WHEN loan_num > 1 THEN 'REPEAT' ELSE 'FIRST' END"""

_VAT = """CAST(CASE country_id WHEN 12 THEN 0.16 WHEN 22 THEN 0.19 WHEN 24 THEN 0.18 END AS DECIMAL(3,2))"""

_REVENUE_USD = "CASE WHEN percent_from_fee = 0 THEN 0::DOUBLE ELSE revenue_local / usd_rate END"


def _usd(column: str) -> str:
    return f"CAST({column} AS DOUBLE) / usd_rate"


_USD_LIST = f"""{_usd('total_repayment_amount')} AS total_repayment_amount_usd, {_usd('fga_fee')} AS fga_sum_usd,
    {_usd('disbursed_amount')} AS disbursed_amount_usd, {_usd('paid_amount')} AS paid_total_usd,
    {_usd('interest_amount')} AS fixed_fee_usd,
    CAST(fga_fee AS DOUBLE) / CAST(disbursed_amount AS DOUBLE) AS fga_rate"""

_WITH_RATE = """fin f LEFT JOIN newest_collection n USING (financing_id)
    LEFT JOIN currency x ON x.country_id = f.country_id AND x.currency_dt_part =
        CASE WHEN n.last_collection_date IS NULL THEN f.start_date ELSE n.last_collection_date END - 1"""

_FORM = """
    SELECT pw.product_id, 'form ' || pw.product_id AS product_name, 'window ' || pw.window_id AS window_name,
           pw.window_order, f.field_name, f.p_partkey AS field_order,
           row_number() OVER (PARTITION BY pw.product_id ORDER BY pw.window_order, f.p_partkey)
               AS overall_order
    FROM (SELECT p_brand AS product_id, p_type AS window_id, min(p_partkey) AS window_order FROM part GROUP BY ALL) pw
    JOIN (SELECT p_type, p_partkey, concat_ws('#', p_name, p_partkey) AS field_name FROM part WHERE p_size > 5) f
      ON f.p_type = pw.window_id
    WHERE {where}"""


_NEWEST_VALUES = "SELECT application_id, key, arg_max(value, seq) AS value FROM typed_keys GROUP BY 1, 2"

_NEWEST_COLUMNS = """
    SELECT user_id AS application_id,
           max(CASE WHEN event_type = 'signup' THEN CAST(user_id % 3 + 1 AS INT) END) AS product_id,
           max(CASE WHEN event_type IN ('signup', 'view') THEN 'client ' || user_id END) AS client_id,
           arg_max(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END, ts)
               FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS current_window_id,
           arg_max(CASE event_type WHEN 'purchase' THEN 'COMPLETED' ELSE 'IN_PROGRESS' END, ts)
               FILTER (WHERE event_type IN ('purchase', 'signup')) AS status
    FROM events GROUP BY 1"""


_SCHEDULE_AMOUNTS = ["total_payment", "principal_part", "interest_part", "open_principal"]
_DECIMALS = {
    "annuity_payment": ["payment", "payment_no_rate", "payment_no_term", "payment_long"],
    "forecast_schedule": _SCHEDULE_AMOUNTS,
    "recalculate_schedule": _SCHEDULE_AMOUNTS,
    "latest_version": _SCHEDULE_AMOUNTS,
    "refresh_loan_status": ["amount", "interest_rate"],
    "refreshed_loans": ["amount", "interest_rate"],
    "recalculate_and_refresh": _SCHEDULE_AMOUNTS,
    "payments_by_billing_month": ["total_payment_amount"],
    "vat_by_country": ["vat"],
    "revenue_snapshot_day": [
        "total_repayment_amount_local", "fga_sum_local", "disbursed_amount_local", "paid_total_local",
        "fixed_fee_local", "vat", "refill_amount",
    ],
}


def all_oracles() -> dict[str, str]:
    """SQL per query, with decimals as doubles and id lists as text like the queries."""
    return {name: _plain(name, sql) for name, sql in _oracles().items()}


def _plain(name: str, sql: str) -> str:
    casts = [f"CAST({x} AS DOUBLE) AS {x}" for x in _DECIMALS.get(name, [])]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


def _oracles() -> dict[str, str]:
    fixed_status, fixed_label = _ladder("25")
    policy_status, policy_label = _ladder("(100 // periods)")
    return {
        "expand_terms": """
            SELECT p_partkey AS policy_id, p_size + 1 AS periods, CAST(p_partkey % 31 + 1 AS INT) AS period_length,
                   p_size % 30 + 20 AS total_interest_rate,
                   CAST((p_size + 1) * (p_partkey % 31 + 1) AS INT) AS horizon_days,
                   CAST(p_partkey % 31 + 1 AS INT) AS period_1, CAST(2 * (p_partkey % 31 + 1) AS INT) AS period_2,
                   CAST(3 * (p_partkey % 31 + 1) AS INT) AS period_3
            FROM part""",
        "open_balances_flat": with_ctes(f"SELECT {BALANCE} FROM flat_balances"),
        "open_balances_policy": with_ctes(f"SELECT {BALANCE} FROM policy_balances"),
        "upsert_loans": with_ctes(
            "SELECT * FROM loan_batch UNION ALL SELECT * FROM loans WHERE id NOT IN (SELECT id FROM loan_batch)"
        ),
        "upsert_loans_balances": with_ctes(
            f"SELECT {BALANCE} FROM policy_balances WHERE loan_id NOT IN (SELECT id FROM loan_batch)"
        ),
        "add_loans_flat_batch": _batch_opening(),
        "add_loans_policy_all": _reopened(),
        "upsert_payments": with_ctes(
            f"""SELECT * FROM settled WHERE id NOT IN (SELECT id FROM today) UNION ALL SELECT * FROM today""",
            {"today": f"SELECT * FROM staged WHERE CAST(payment_dttm AS DATE) = {_date(c.PAYMENT_DAY)}"},
        ),
        "rebuild_payments": with_ctes(
            f"""SELECT * FROM settled WHERE payment_dttm < {_date(c.REPLAY_FROM)} AND id NOT IN (SELECT id FROM replay)
                UNION ALL SELECT * FROM replay""",
            {
                "replay": f"""
                    SELECT * FROM staged WHERE CAST(payment_dttm AS DATE) >= {_date(c.REPLAY_FROM)}
                    AND CAST(payment_dttm AS DATE) < {_date(c.REPLAY_TO)}"""
            },
        ),
        "daily_totals": with_ctes("SELECT * FROM daily"),
        "payment_ids": with_ctes("SELECT loan_id, CAST(payment_dttm AS DATE) AS payment_dttm, id FROM payments"),
        "roll_one_day": with_ctes(_step("policy_balances")),
        "close_day_history": with_ctes(f"SELECT {BALANCE} FROM policy_balances UNION ALL {_step('policy_balances')}"),
        "rebuild_balances": with_ctes(
            f"SELECT {BALANCE} FROM walk", _rolled("policy_balances", c.REBUILD_FROM, c.REBUILD_TO), recursive=True
        ),
        "loan_day_report_fixed": _report("flat_balances", "products_flat", "p.policy_id", "25"),
        "loan_day_report": _flagship(),
        "loan_day_report_stored": _flagship(),
        "report_spans": _as_spans(),
        "report_on_day": f"SELECT * FROM ({_flagship()}) WHERE report_dt = {_date(c.LADDER_DAY)}",
        "report_of_range": f"""
            SELECT * FROM ({_flagship()}) WHERE report_dt BETWEEN {_date(c.RANGE_FROM)} AND {_date(c.RANGE_TO)}""",
        "report_of_loan": f"SELECT * FROM ({_flagship()}) WHERE loan_id = {c.ONE_LOAN}",
        "catch_up_balances": with_ctes(
            f"SELECT {BALANCE} FROM walk",
            {
                "standing": f"""
                    SELECT {BALANCE} FROM policy_balances UNION ALL {_step('policy_balances', 'loan_id % 3 = 0')}""",
                **_caught_up("standing", c.CATCH_UP_TO),
            },
            recursive=True,
        ),
        "changed_loans": with_ctes(
            """SELECT loan_id, min(payment_dttm) AS changed_from
               FROM daily b FULL JOIN daily_after a USING (loan_id, payment_dttm)
               WHERE coalesce(b.daily_total_amount, 0) <> coalesce(a.daily_total_amount, 0) GROUP BY loan_id""",
            _corrected("daily_after"),
        ),
        "rebuild_changed": with_ctes(
            f"SELECT {BALANCE} FROM walk",
            _corrected("daily") | _caught_up("policy_balances", c.CATCH_UP_TO),
            recursive=True,
        ),
        "delinquency_labels": with_ctes(
            f"""
            SELECT id, {_loan_status('balance')} AS loan_status, {fixed_status} AS collection_fixed,
                   {policy_status} AS collection_policy, {fixed_label} AS dpd_fixed, {policy_label} AS dpd_policy
            FROM (
                SELECT l.id, l.status, CAST(l.open_dttm AS DATE) AS opened, {_date(c.LADDER_DAY)} AS day,
                       t.periods, t.period_length AS length, o.approved_amount AS approved,
                       o.approved_amount - d.paid AS balance
                FROM loans l JOIN products_policy p ON p.id = l.product_id JOIN terms t ON t.policy_id = {_MOVED}
                JOIN offers o ON o.id = l.id
                LEFT JOIN (SELECT loan_id, CAST(sum(payment_amount) AS BIGINT) AS paid FROM payments GROUP BY 1) d
                       ON d.loan_id = l.id)"""
        ),
        "set_where_policy": with_ctes(
            """
            SELECT id, product_id, offer_id, CASE WHEN hit THEN 'CLOSED' ELSE status END AS status, open_dttm, due_dttm,
                   CASE WHEN hit THEN due_dttm END AS close_dttm
            FROM (SELECT *, status = 'DEFAULT' AND due_dttm < TIMESTAMP '2025-06-01 00:00:00' AS hit FROM loans)"""
        ),
        "cut_balances": with_ctes(
            f"SELECT {BALANCE} FROM policy_balances WHERE balance_date < {_date(c.CUT_FROM)}"
        ),
        "cut_payments": with_ctes(
            f"SELECT * FROM payments WHERE loan_id <> {c.ONE_LOAN} OR payment_dttm < {_date(c.CUT_FROM)}"
        ),
        "report_slice": f"""
            SELECT * FROM ({_flagship()})
            WHERE report_dt <= {_date(c.LADDER_DAY)}""",
        "balance_slice": with_ctes(f"SELECT {BALANCE} FROM policy_balances"),
        "payment_slice": with_ctes(
            f"SELECT * FROM payments WHERE payment_dttm >= {_date(c.CUT_FROM)}"
        ),
        "active_offers": with_ctes("SELECT * FROM offers WHERE status = 'ACTIVE'"),
        "annuity_payment": with_ctes(
            f"""
            SELECT id, {_level('amount', 'g')} AS payment, {_even('amount', 'term_months')} AS payment_no_rate,
                   CAST(0 AS DECIMAL(14,2)) AS payment_no_term,
                   {_annuity('amount', '(interest_rate / 10000)', '(45 * term_months)')} AS payment_long
            FROM contract_loans JOIN growth g ON g.percent = interest_rate AND g.m = term_months""",
            {"growth": _GROWTH},
        ),
        "forecast_schedule": with_ctes("SELECT * FROM forecast_rows", _forecast("TRUE"), recursive=True),
        "recalculate_schedule": with_ctes("SELECT * FROM recalc_rows", _recalculated(), recursive=True),
        "refresh_loan_status": with_ctes(_REFRESHED, _recalculated(), recursive=True),
        "refreshed_loans": with_ctes(_REFRESHED, _recalculated(), recursive=True),
        "recalculate_and_refresh": with_ctes(
            f"SELECT r.*, s.status AS new_status FROM recalc_rows r JOIN ({_REFRESHED}) s ON s.id = r.loan_id",
            _recalculated(),
            recursive=True,
        ),
        "latest_version": _versions(
            "SELECT * FROM versions QUALIFY version = max(version) OVER (PARTITION BY loan_id)"
        ),
        "package_schedule": _versions(
            """
            SELECT loan_id, version, '[' || string_agg(
                '{"payment_number":' || payment_number || ',"payment_date":"' || payment_date
                || '","total_payment":' || total_payment || ',"principal_part":' || principal_part
                || ',"interest_part":' || interest_part || ',"open_principal":' || open_principal
                || ',"status":"' || status || '"}', ',' ORDER BY payment_number) || ']' AS repayment_schedule
            FROM versions GROUP BY loan_id, version"""
        ),
        "payments_by_billing_month": with_ctes(
            """
            SELECT loan_id, CAST(date_trunc('month', payment_date + INTERVAL 1 MONTH) AS DATE) AS month,
                   CAST(sum(payment_amount) AS DECIMAL(24,2)) AS total_payment_amount
            FROM contract_payments GROUP BY 1, 2"""
        ),
        "unknown_loans": with_ctes(
            """SELECT c_custkey AS id FROM customer
               WHERE c_custkey NOT IN (SELECT id FROM contract_loans WHERE status = 'active')"""
        ),
        "loan_cycle": with_ctes(
            f"SELECT financing_id, user_id, start_date, loan_num, {_CYCLE} AS loan_num_status FROM numbered"
        ),
        "npl_buckets": with_ctes(
            f"""
            SELECT financing_id, due_date, last_collection_date, {_NPL} AS loan_npl_status
            FROM (SELECT f.*, n.last_collection_date,
                         date_diff('day', f.due_date, n.last_collection_date) AS late
                  FROM fin f LEFT JOIN newest_collection n USING (financing_id))"""
        ),
        "last_collection": with_ctes("SELECT * FROM newest_collection"),
        "previous_day_rate": with_ctes(
            f"SELECT financing_id, f.country_id, last_collection_date, usd_rate FROM {_WITH_RATE}"
        ),
        "usd_columns": with_ctes(f"SELECT financing_id, {_USD_LIST} FROM {_WITH_RATE}"),
        "fee_share": with_ctes("SELECT financing_id, loan_num, percent_from_fee FROM earned"),
        "revenue": with_ctes(
            f"SELECT financing_id, percent_from_fee, revenue_local, {_REVENUE_USD} AS revenue_usd FROM revenues"
        ),
        "vat_by_country": with_ctes(f"SELECT financing_id, country_id, {_VAT} AS vat FROM fin"),
        "revenue_snapshot_day": with_ctes(
            f"""
            SELECT country_name, country_id, financing_id, user_id, driver_id AS external_merchant_id, loan_num,
                   financing_status AS status_prod, {_CYCLE} AS loan_num_status, {_NPL} AS loan_npl_status,
                   start_date AS loan_start_date, last_collection_date,
                   CAST(-late AS INT) AS last_collection_date_to_due_date_days, due_date,
                   usd_rate AS usd_rate_at_last_collection_date, repayment_rate,
                   total_repayment_amount AS total_repayment_amount_local, fga_fee AS fga_sum_local,
                   disbursed_amount AS disbursed_amount_local, paid_amount AS paid_total_local,
                   interest_amount AS fixed_fee_local, {_USD_LIST}, {_VAT} AS vat, percent_from_fee, revenue_local,
                   {_REVENUE_USD} AS revenue_usd, {_date(c.AS_OF)} AS snap_dt_part, parent_financing_id, refill_amount
            FROM revenues LEFT JOIN drivers ON dwh_driver_id = user_id"""
        ),
        "form_fields": _FORM.format(where="pw.window_id <> 'LARGE'"),
        "form_fields_switched_on": _FORM.format(where="TRUE"),
        "application_values": with_ctes(
            """SELECT application_id, key, value FROM patch_keys
               QUALIFY row_number() OVER (PARTITION BY application_id, key ORDER BY seq DESC) = 1"""
        ),
        "application_state": with_ctes(
            """
            SELECT application_id, current_window_id, status, data
            FROM (SELECT application_id,
                         arg_max(window_id, seq) FILTER (WHERE window_id IS NOT NULL) AS current_window_id,
                         arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status
                  FROM patches GROUP BY 1)
            JOIN (SELECT application_id, string_agg(key || '=' || value, ',' ORDER BY key) AS data
                  FROM (SELECT application_id, key, arg_max(value, seq) AS value FROM patch_keys GROUP BY 1, 2)
                  GROUP BY 1) USING (application_id)"""
        ),
        "application_documents": with_ctes(
            f"""
            SELECT application_id, product_id, client_id, current_window_id, status, application_data
            FROM ({_NEWEST_COLUMNS})
            JOIN (SELECT application_id, '{{' || string_agg('"' || key || '":' || value, ',' ORDER BY key) || '}}'
                         AS application_data
                  FROM ({_NEWEST_VALUES}) GROUP BY 1) USING (application_id)"""
        ),
        "application_typed_values": with_ctes(
            f"""
            SELECT application_id, CAST(max(value) FILTER (WHERE key = 'view') AS INT) AS views,
                   max(value) FILTER (WHERE key = 'purchase') = 'true' AS even,
                   CAST(json_extract(CAST(max(value) FILTER (WHERE key = 'signup') AS JSON), '$.at.n') AS BIGINT) AS signup_n,
                   CASE WHEN max(value) FILTER (WHERE key = 'click') IS NOT NULL THEN 'STRING' END AS click_type,
                   coalesce(max(value) FILTER (WHERE key = 'error') = 'null', FALSE) AS error_is_null
            FROM ({_NEWEST_VALUES}) GROUP BY 1"""
        ),
        "ingest_attributes": with_ctes("SELECT * FROM attributes"),
        "attributes_with_expiry": with_ctes(
            """SELECT a.*, m.expiration_policy FROM attributes a JOIN attribute_meta m ON m.id = a.attr_meta_id"""
        ),
        "audit_not_null": with_ctes(
            """
            SELECT id AS loan_id, CAST(open_dttm AS DATE) AS balance_date, CAST(NULL AS INT) AS open_principal,
                   CAST(NULL AS INT) AS open_interest, CAST(NULL AS INT) AS open_vat, CAST(NULL AS INT) AS loan_balance,
                   'open_principal,loan_balance' AS null_columns
            FROM loans WHERE status = 'ACTIVE' AND offer_id NOT IN (SELECT id FROM low_offers)"""
        ),
        "audit_unique": """
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "audit_fk": with_ctes("SELECT * FROM loans WHERE offer_id NOT IN (SELECT id FROM low_offers)"),
        "audit_sources": with_ctes("SELECT * FROM incoming WHERE source_name = 'unlisted'"),
        "audit_overlaps": with_ctes(
            """
            SELECT financing_id, user_id, start_date, due_date, reaches
            FROM (SELECT *, max(due_date) OVER (PARTITION BY user_id ORDER BY start_date, financing_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reaches FROM fin)
            WHERE reaches >= start_date"""
        ),
        "audit_rules": with_ctes(
            """
            SELECT id, status, array_to_string([x FOR x IN [
                       CASE WHEN id % 5 = 0 THEN 'close_dttm is null' END,
                       CASE WHEN length(status) > 6 THEN 'status is longer than 6' END,
                       CASE WHEN id NOT IN (SELECT id FROM low_offers) THEN 'id has no parent' END,
                       CASE WHEN id IN (SELECT id FROM loan_batch) THEN 'id is not unique' END] IF x IS NOT NULL], ',')
                   AS violations
            FROM (SELECT id, status FROM loans UNION ALL SELECT id, status FROM loan_batch)
            WHERE violations <> ''"""
        ),
        "audit_length": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9",
    }


def _corrected(name: str) -> dict[str, str]:
    """Daily totals after the correction of the payments."""
    return {
        "returned": f"SELECT * FROM staged WHERE CAST(payment_dttm AS DATE) = {_date(c.PAYMENT_DAY)}",
        name: f"""
            SELECT loan_id, CAST(payment_dttm AS DATE) AS payment_dttm,
                   CAST(sum(payment_amount) AS BIGINT) AS daily_total_amount, count(*) AS payments_count
            FROM (SELECT * FROM payments WHERE id NOT IN (SELECT id FROM returned) UNION ALL SELECT * FROM returned)
            WHERE loan_id <> {c.ONE_LOAN} OR payment_dttm < {_date(c.CUT_FROM)}
            GROUP BY ALL""",
    }


def _opening_rows(loans: str, terms: str) -> str:
    """Opening rows of the ACTIVE loans of ``loans``; ``terms`` gives rate and days per product."""
    vat = "((32 * x + 365) // 730 + 50) // 100"
    return f"""
        SELECT loan_id, balance_date, a AS open_principal, CAST(x // 365 AS INT) AS open_interest,
               CAST({vat} AS INT) AS open_vat, CAST(a + x // 365 + {vat} AS INT) AS loan_balance
        FROM (SELECT l.id AS loan_id, CAST(l.open_dttm AS DATE) AS balance_date, o.approved_amount AS a,
                     (CAST(o.approved_amount AS BIGINT) * p.rate // 100) * p.days AS x
              FROM {loans} l JOIN ({terms}) p ON p.product_id = l.product_id
              LEFT JOIN offers o ON o.id = l.offer_id WHERE l.status = 'ACTIVE')"""


def _batch_opening() -> str:
    terms = "SELECT id AS product_id, interest_rate AS rate, period_days AS days FROM products_flat"
    return with_ctes(
        f"""
        SELECT {BALANCE} FROM flat_balances WHERE loan_id NOT IN (SELECT id FROM loan_batch)
        UNION ALL {_opening_rows('loan_batch', terms)}"""
    )


def _reopened() -> str:
    terms = """SELECT p.id AS product_id, t.rate, t.periods * t.period_length AS days
               FROM products_policy p JOIN terms t USING (policy_id)"""
    return with_ctes(
        f"""
        SELECT {BALANCE} FROM policy_balances WHERE loan_id NOT IN (SELECT id FROM loan_batch)
        UNION ALL {_opening_rows('merged', terms)}""",
        {"merged": "SELECT * FROM loan_batch UNION ALL SELECT * FROM loans WHERE id NOT IN (SELECT id FROM loan_batch)"},
    )
