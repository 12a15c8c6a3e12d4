"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.bindings import PROJECT, Bindings
from ledgerloom.functions import ladder
from ledgerloom.functions.annuity import annuity
from ledgerloom.functions.revenue import npl_status, vat_rate
from ledgerloom.operators import accrual, attributes, audit, balances, forms, opening, payments, rewrites, schedule, spans
from ledgerloom.operators import revenue as rev
from ledgerloom.plans.daily_cycle import add_loans_flat, add_loans_policy, catch_up_day, close_day
from ledgerloom.plans.revenue_snapshot import revenue_snapshot

Query = Callable[[SparkSession, str], DataFrame]

# Fixed dates of the queries; the oracle uses the same ones.
REBUILD_FROM, REBUILD_TO = "2025-02-15", "2025-04-01"
REPORT_START, REPORT_END = accrual.CALENDAR_START, accrual.CALENDAR_END
HISTORY_TO = REPORT_END
CATCH_UP_TO = "2025-05-20"
RANGE_FROM, RANGE_TO = "2025-06-25", "2025-07-05"
PAYMENT_DAY = "2025-03-01"
REPLAY_FROM, REPLAY_TO = "2025-02-01", "2025-04-15"
CUT_FROM = "2025-03-10"
LADDER_DAY = "2025-05-15"
AS_OF = "2025-06-30"
REFRESH_DAY = "1998-06-30"
ONE_LOAN = 42
# A payment line stands for some 25 stored days; their sorts stay small in so many times as many partitions.
DAYS_SPREAD = 4

_REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    _REGISTRY[fn.__name__] = lambda spark, sf_dir: _plain(fn(Bindings(spark, sf_dir)))
    return fn


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and id lists as text, which both engines hand over in one form."""
    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, ",").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- accrual mart -----------------------------------------------------------------------------


@query
def expand_terms(b: Bindings) -> DataFrame:
    return opening.expand_terms(b.wide_terms())


@query
def open_balances_flat(b: Bindings) -> DataFrame:
    return opening.open_balances_flat(b.loans(), b.products_flat(), b.offers())


@query
def open_balances_policy(b: Bindings) -> DataFrame:
    return opening.open_balances_policy(b.loans(), b.products_policy(), b.offers(), b.terms())


@query
def upsert_loans(b: Bindings) -> DataFrame:
    return rewrites.upsert_loans(b.loans(), open_balances_policy(b), b.loan_batch())[0]


@query
def upsert_loans_balances(b: Bindings) -> DataFrame:
    return rewrites.upsert_loans(b.loans(), open_balances_policy(b), b.loan_batch())[1]


@query
def add_loans_flat_batch(b: Bindings) -> DataFrame:
    return add_loans_flat(b.loans(), open_balances_flat(b), b.loan_batch(), b.products_flat(), b.offers())[1]


@query
def add_loans_policy_all(b: Bindings) -> DataFrame:
    """Every active loan of the merged table opened again, as a second batch does in the source rules."""
    return add_loans_policy(
        b.loans(), open_balances_policy(b), b.loan_batch(), b.products_policy(), b.offers(), b.terms(),
        reopen_all=True,
    )[1]


@query
def upsert_payments(b: Bindings) -> DataFrame:
    return rewrites.upsert_payments(b.settled_payments(), b.staged_payments(), PAYMENT_DAY)


@query
def rebuild_payments(b: Bindings) -> DataFrame:
    return rewrites.rebuild_payments(b.settled_payments(), b.staged_payments(), REPLAY_FROM, REPLAY_TO)


@query
def daily_totals(b: Bindings) -> DataFrame:
    return payments.daily_totals(b.payments())


@query
def payment_ids(b: Bindings) -> DataFrame:
    return payments.payment_ids(b.payments())


@query
def roll_one_day(b: Bindings) -> DataFrame:
    return balances.roll_one_day(open_balances_policy(b), payments.daily_totals(b.payments()))


@query
def close_day_history(b: Bindings) -> DataFrame:
    return close_day(open_balances_policy(b), b.payments())


@query
def rebuild_balances(b: Bindings) -> DataFrame:
    daily = payments.daily_totals(b.payments(), until=REBUILD_TO)
    return balances.rebuild_balances(open_balances_policy(b), daily, REBUILD_FROM, REBUILD_TO)


@query
def catch_up_balances(b: Bindings) -> DataFrame:
    """Loans that stand at mixed days, most at their opening and some a day on, brought to one day."""
    opened = open_balances_policy(b)
    some = balances.roll_one_day(opened.filter(F.col("loan_id") % 3 == 0), payments.daily_totals(b.payments()))
    standing = opened.unionByName(some)
    return standing.unionByName(catch_up_day(standing, b.payments(), CATCH_UP_TO))


def _corrected_payments(b: Bindings) -> DataFrame:
    """Payments after a correction: a day's returned items come again with another amount, one loan's last ones go."""
    return cut_payments_of(rewrites.upsert_payments(b.payments_as_read(), b.staged_payments(), PAYMENT_DAY))


def cut_payments_of(rows: DataFrame) -> DataFrame:
    return rewrites.cut_from(rows, CUT_FROM, "payment_dttm", loan_id=ONE_LOAN)


@query
def changed_loans(b: Bindings) -> DataFrame:
    return balances.changed_loans(b.payments(), _corrected_payments(b))


@query
def rebuild_changed(b: Bindings) -> DataFrame:
    """The history after a correction, only the loans it concerns rolled again."""
    opened, after = b.by_loan(open_balances_policy(b)), _corrected_payments(b)
    history = opened.unionByName(balances.catch_up(opened, payments.daily_totals(b.payments()), CATCH_UP_TO))
    changed = balances.changed_loans(b.payments(), after)
    return balances.merge_rebuilt(
        history, *balances.rebuild_changed(history, payments.daily_totals(after), changed, CATCH_UP_TO)
    )


def _four_day_products(b: Bindings) -> DataFrame:
    """General loans moved to the 4-day policy."""
    return rewrites.set_where(b.products_policy(), F.col("product_name") == "general_loan", "policy_id", 6003)


def _fixed_spans(b: Bindings) -> DataFrame:
    daily = payments.daily_totals(b.payments(), until="2026-01-02")
    held = balances.balance_spans(b.by_loan(open_balances_flat(b)), daily, HISTORY_TO)
    return spans.report_spans_fixed(b.loans(), b.products_flat(), b.offers(), b.terms(), daily, held)


@query
def loan_day_report_fixed(b: Bindings) -> DataFrame:
    return spans.report_between(_fixed_spans(b))


@query
def report_spans(b: Bindings) -> DataFrame:
    """Opening, whole history to the calendar's end and the report over it, as spans of days."""
    products = _four_day_products(b)
    daily = payments.daily_totals(b.payments(), until="2026-01-02")
    opened = opening.open_balances_policy(b.loans(), products, b.offers(), b.terms())
    held = balances.balance_spans(b.by_loan(opened), daily, HISTORY_TO)
    return spans.report_spans(b.loans(), products, b.offers(), b.terms(), daily, held)


@query
def loan_day_report(b: Bindings) -> DataFrame:
    """Flagship: the whole calendar, every loan on every day of its history."""
    return spans.report_between(report_spans(b))


@query
def loan_day_report_stored(b: Bindings) -> DataFrame:
    """The same report from a history of daily balance rows."""
    products = _four_day_products(b)
    opened = b.by_loan(opening.open_balances_policy(b.loans(), products, b.offers(), b.terms()), DAYS_SPREAD)
    daily = payments.daily_totals(b.payments(DAYS_SPREAD))
    history = opened.unionByName(balances.catch_up(opened, daily, HISTORY_TO))
    return accrual.loan_day_report(b.loans(), products, b.offers(), b.terms(), daily, history)


@query
def report_on_day(b: Bindings) -> DataFrame:
    return spans.report_on(report_spans(b), LADDER_DAY)


@query
def report_of_range(b: Bindings) -> DataFrame:
    return spans.report_between(report_spans(b), RANGE_FROM, RANGE_TO)


@query
def report_of_loan(b: Bindings) -> DataFrame:
    return spans.report_between(report_spans(b), loan_id=ONE_LOAN)


@query
def delinquency_labels(b: Bindings) -> DataFrame:
    """The three labels alone, on the balance left after all payments."""
    paid = b.payments().groupBy(F.col("loan_id").alias("id")).agg(F.sum("payment_amount").alias("paid"))
    approved = b.offers().select("id", "approved_amount")
    products = _four_day_products(b).select(F.col("id").alias("product_id"), "policy_id")
    rows = (
        b.loans().join(products, "product_id").join(opening.parse_terms(b.terms()), "policy_id")
        .join(approved, "id").join(paid, "id", "left")
        .withColumn("balance", F.col("approved_amount") - F.col("paid"))
    )
    day, opened, balance = F.lit(LADDER_DAY).cast("date"), F.to_date("open_dttm"), F.col("balance")
    fixed = (day, opened, F.col("periods"), F.col("period_length"), balance, F.col("approved_amount"))
    step = ladder.policy_step(F.col("periods"))
    return rows.select(
        "id",
        ladder.loan_status(balance, F.col("status")).alias("loan_status"),
        ladder.collection_status(*fixed, ladder.fixed_step()).alias("collection_fixed"),
        ladder.collection_status(*fixed, step).alias("collection_policy"),
        ladder.dpd_label(*fixed, ladder.fixed_step()).alias("dpd_fixed"),
        ladder.dpd_label(*fixed, step).alias("dpd_policy"),
    )


@query
def set_where_policy(b: Bindings) -> DataFrame:
    """Conditional update, on loans: defaulted loans that fall due before May are closed on that day."""
    late = (F.col("status") == "DEFAULT") & (F.col("due_dttm") < F.lit("2025-06-01").cast("timestamp_ntz"))
    closed = rewrites.set_where(b.loans(), late, "close_dttm", F.col("due_dttm"))
    return rewrites.set_where(closed, F.col("close_dttm").isNotNull(), "status", "CLOSED")


@query
def cut_balances(b: Bindings) -> DataFrame:
    return rewrites.cut_from(open_balances_policy(b), CUT_FROM, "balance_date")


@query
def cut_payments(b: Bindings) -> DataFrame:
    return rewrites.cut_from(b.payments(), CUT_FROM, "payment_dttm", loan_id=ONE_LOAN)


@query
def report_slice(b: Bindings) -> DataFrame:
    return spans.report_slice(report_spans(b), LADDER_DAY)


@query
def balance_slice(b: Bindings) -> DataFrame:
    return accrual.balance_slice(open_balances_policy(b))


@query
def payment_slice(b: Bindings) -> DataFrame:
    return accrual.payment_slice(b.payments(), CUT_FROM)


@query
def active_offers(b: Bindings) -> DataFrame:
    return accrual.active_offers(b.offers())


# -- contracts --------------------------------------------------------------------------------


@query
def annuity_payment(b: Bindings) -> DataFrame:
    """Level payments at the loan's rate, at no rate, and over a long term."""
    rate = (F.col("interest_rate") / 100).cast("decimal(14,8)")
    none = F.lit(0).cast("decimal(14,8)")
    amount, term = F.col("amount"), F.col("term_months")
    return b.contract_loans().select(
        "id",
        annuity(amount, rate, term).alias("payment"),
        annuity(amount, none, term).alias("payment_no_rate"),
        annuity(amount, rate, term - term).alias("payment_no_term"),
        annuity(amount, (rate / 100).cast("decimal(14,8)"), term * 45).alias("payment_long"),
    )


@query
def forecast_schedule(b: Bindings) -> DataFrame:
    return schedule.forecast_schedule(b.contract_loans())


def _first_versions(b: Bindings) -> DataFrame:
    """Loans that are not overdue already have their forecast."""
    return schedule.forecast_schedule(b.contract_loans().filter(F.col("status") == "active"))


@query
def recalculate_schedule(b: Bindings) -> DataFrame:
    return schedule.recalculate_schedule(b.contract_loans(), b.contract_payments(), _first_versions(b))


def _recalculated(b: Bindings) -> DataFrame:
    return schedule.recalculate(b.contract_loans(), b.contract_payments(), _first_versions(b), REFRESH_DAY)


@query
def recalculate_and_refresh(b: Bindings) -> DataFrame:
    """Schedule rows and the loan's new status, both of one recalculation."""
    return schedule.schedule_rows(_recalculated(b), carried=("new_status",))


@query
def refreshed_loans(b: Bindings) -> DataFrame:
    return schedule.refreshed_loans(_recalculated(b))


def _all_versions(b: Bindings) -> DataFrame:
    return _first_versions(b).unionByName(recalculate_schedule(b))


@query
def refresh_loan_status(b: Bindings) -> DataFrame:
    return schedule.refresh_loan_status(b.contract_loans(), recalculate_schedule(b), REFRESH_DAY)


@query
def latest_version(b: Bindings) -> DataFrame:
    return schedule.latest_version(_all_versions(b))


@query
def package_schedule(b: Bindings) -> DataFrame:
    return schedule.package_schedule(_all_versions(b))


@query
def payments_by_billing_month(b: Bindings) -> DataFrame:
    return payments.payments_by_billing_month(b.contract_payments())


@query
def unknown_loans(b: Bindings) -> DataFrame:
    """Customers asked for as if they were active contracts."""
    wanted = b.table("customer").select(F.col("c_custkey").alias("id"))
    return schedule.unknown_loans(wanted, b.contract_loans().filter(F.col("status") == "active"))


# -- revenue ----------------------------------------------------------------------------------


def _collected(b: Bindings, fin: DataFrame) -> DataFrame:
    return fin.join(rev.last_collection(b.collections(), PROJECT), "financing_id", "left")


def _project_loans(b: Bindings) -> DataFrame:
    """Numbered loans of the project with last collection, rate and offer fees."""
    loans = rev.loan_cycle(b.fin().filter(F.col("project_name") == PROJECT))
    offer = b.fee_offers().withColumnRenamed("interest_amount", "offer_interest_amount")
    old = b.historical_offers().withColumnRenamed("fixed_fee", "offer_fixed_fee")
    joined = _collected(b, loans).join(offer, "offer_id", "left").join(old, "offer_id", "left")
    return rev.previous_day_rate(joined, b.currency())


@query
def loan_cycle(b: Bindings) -> DataFrame:
    return rev.loan_cycle(b.fin()).select("financing_id", "user_id", "start_date", "loan_num", "loan_num_status")


@query
def npl_buckets(b: Bindings) -> DataFrame:
    status = npl_status(
        F.col("financing_status"), F.col("status"), F.col("due_date"), F.col("last_collection_date"),
        F.lit(AS_OF).cast("date"),
    )
    return _collected(b, b.fin()).select("financing_id", "due_date", "last_collection_date", status.alias("loan_npl_status"))


@query
def last_collection(b: Bindings) -> DataFrame:
    return rev.last_collection(b.collections(), PROJECT)


@query
def previous_day_rate(b: Bindings) -> DataFrame:
    rows = rev.previous_day_rate(_collected(b, b.fin()), b.currency())
    return rows.select("financing_id", "country_id", "last_collection_date", "usd_rate")


@query
def usd_columns(b: Bindings) -> DataFrame:
    rows = rev.usd_columns(rev.previous_day_rate(_collected(b, b.fin()), b.currency()))
    return rows.select("financing_id", *[f"{c}_usd" for c in rev.USD_AMOUNTS.values()], "fga_rate")


@query
def fee_share(b: Bindings) -> DataFrame:
    rows = rev.fee_share(_project_loans(b), rev.rate_table(b.spark))
    return rows.select("financing_id", "loan_num", "percent_from_fee")


@query
def revenue(b: Bindings) -> DataFrame:
    rows = rev.revenue(_project_loans(b), rev.rate_table(b.spark))
    return rows.select("financing_id", "percent_from_fee", "revenue_local", "revenue_usd")


@query
def vat_by_country(b: Bindings) -> DataFrame:
    return b.fin().select("financing_id", "country_id", vat_rate(F.col("country_id")).alias("vat"))


@query
def revenue_snapshot_day(b: Bindings) -> DataFrame:
    return revenue_snapshot(
        b.fin(), b.drivers(), b.fee_offers(), b.historical_offers(), b.collections(), b.currency(), AS_OF, PROJECT
    )


# -- forms, attributes, audit -----------------------------------------------------------------


@query
def form_fields(b: Bindings) -> DataFrame:
    return forms.form_fields(b.form_products(), b.windows(), b.fields(), b.product_windows(), b.window_fields())


@query
def form_fields_switched_on(b: Bindings) -> DataFrame:
    """The same form after a window is turned on again."""
    windows = rewrites.set_where(b.windows(), F.col("window_name") == "window LARGE", "is_active", True)
    return forms.form_fields(b.form_products(), windows, b.fields(), b.product_windows(), b.window_fields())


@query
def application_values(b: Bindings) -> DataFrame:
    return forms.merged_values(b.patches())


@query
def application_state(b: Bindings) -> DataFrame:
    state = forms.application_state(b.patches())
    pairs = F.transform(F.map_entries("application_data"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return state.select("application_id", "current_window_id", "status", F.array_join(pairs, ",").alias("data"))


@query
def application_documents(b: Bindings) -> DataFrame:
    """Typed documents, handed over as JSON text."""
    state = forms.application_documents(b.typed_patches())
    return state.withColumn("application_data", F.to_json("application_data"))


@query
def application_typed_values(b: Bindings) -> DataFrame:
    """Values read out of the documents by their type."""
    state, data = forms.application_documents(b.typed_patches()), F.col("application_data")
    return state.select(
        "application_id",
        F.try_variant_get(data, "$.view", "int").alias("views"),
        F.try_variant_get(data, "$.purchase", "boolean").alias("even"),
        F.try_variant_get(data, "$.signup.at.n", "bigint").alias("signup_n"),
        F.schema_of_variant(F.variant_get(data, "$.click", "variant")).alias("click_type"),
        F.is_variant_null(F.variant_get(data, "$.error", "variant")).alias("error_is_null"),
    )


@query
def ingest_attributes(b: Bindings) -> DataFrame:
    rows = attributes.ingest_attributes(b.incoming(), b.sources(), b.attribute_meta())
    return rows.withColumn("data_hex", F.hex("data")).drop("data")


@query
def attributes_with_expiry(b: Bindings) -> DataFrame:
    rows = attributes.ingest_attributes(b.incoming(), b.sources(), b.attribute_meta())
    return attributes.attributes_with_expiry(rows, b.attribute_meta()).withColumn("data_hex", F.hex("data")).drop("data")


@query
def audit_not_null(b: Bindings) -> DataFrame:
    """Opening balances of loans whose offer is missing."""
    opened = opening.open_balances_policy(b.loans(), b.products_policy(), b.low_priority_offers(), b.terms())
    return audit.audit_not_null(opened, ["loan_id", "open_principal", "loan_balance"])


@query
def audit_unique(b: Bindings) -> DataFrame:
    return audit.audit_unique(b.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def audit_fk(b: Bindings) -> DataFrame:
    return audit.audit_fk(b.loans(), "offer_id", b.low_priority_offers(), "id")


@query
def audit_sources(b: Bindings) -> DataFrame:
    """Incoming attribute values whose source is not listed."""
    return audit.audit_fk(b.incoming(), "source_name", b.sources(), "source_name")


@query
def audit_length(b: Bindings) -> DataFrame:
    return audit.audit_length(b.table("part").select("p_partkey", "p_name"), "p_name", 9)


@query
def audit_overlaps(b: Bindings) -> DataFrame:
    """Loans of one user that begin before an earlier one is due."""
    loans = b.fin().select("financing_id", "user_id", "start_date", "due_date")
    return audit.audit_overlaps(loans, ["user_id"], "start_date", "due_date", "financing_id")


def _audited_loans(b: Bindings) -> DataFrame:
    """A batch written beside the table instead of into it, so that ids repeat."""
    return b.loans().unionByName(b.loan_batch()).withColumn(
        "close_dttm", F.when(F.col("id") % 5 != 0, F.col("due_dttm"))
    )


def loan_rules(b: Bindings) -> list[audit.Rule]:
    return [
        audit.not_null("close_dttm"),
        audit.at_most("status", 6),
        audit.holds("due after opening", F.col("due_dttm") > F.col("open_dttm")),
        audit.references("id", b.low_priority_offers(), "id"),
        audit.unique("id"),
    ]


@query
def audit_rules(b: Bindings) -> DataFrame:
    """Five rules of the loans at once."""
    return audit.audit_rules(_audited_loans(b), loan_rules(b)).select("id", "status", "violations")
