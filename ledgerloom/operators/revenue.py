"""Revenue share per loan: cycle, collections, currency, rate table, revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.revenue import VAT, cycle_label, days_late
from ledgerloom.operators.audit import FIRST_DAY, LAST_DAY, audit_overlaps
from ledgerloom.plans.ranking import ranked

# Percent of the fee by country, agreement dates, loan ordinal and lateness.
# country, from, until (inclusive; None: open), ordinal, regular loans only, in term, <= 60 days late, 61-90 late
RATES = (
    (12, None, "2023-11-30", "first", True, 7.0, 2.1, 1.05),
    (12, None, "2023-11-30", "later", False, 10.0, 3.0, 1.5),
    (12, "2023-12-01", "2024-07-31", "first", True, 7.0, 2.1, 1.05),
    (12, "2023-12-01", "2024-07-31", "later", False, 7.5, 2.25, 1.125),
    (22, "2023-12-01", "2024-07-31", "first", True, 5.5, 1.65, 0.825),
    (22, "2023-12-01", "2024-07-31", "later", False, 6.0, 1.8, 0.9),
    (12, "2024-08-01", None, "any", False, 7.5, 2.25, 1.125),
    (22, "2024-08-01", None, "any", False, 7.5, 2.25, 1.125),
    (24, "2024-08-01", None, "any", False, 7.5, 2.25, 1.125),
)
# Countries whose fee includes VAT, which revenue leaves out.
VAT_INCLUDED = (12, 22)

USD_AMOUNTS = {
    "total_repayment_amount": "total_repayment_amount",
    "fga_fee": "fga_sum",
    "disbursed_amount": "disbursed_amount",
    "paid_amount": "paid_total",
    "interest_amount": "fixed_fee",
}


def _kinds(ordinal: str, regular_only: bool) -> set[tuple[str, str]]:
    """What loans a rate is for: (ordinal, kind)."""
    ordinals = ("first", "later") if ordinal == "any" else (ordinal,)
    return {(o, k) for o in ordinals for k in (("regular",) if regular_only else ("regular", "refill"))}


def _clashes(rates) -> list[tuple]:
    """Pairs of rate rows that would both apply to some loan: a sweep over the periods of each country and kind."""
    found, by_kind = [], {}
    for row in rates:
        for kind in _kinds(row[3], row[4]):
            by_kind.setdefault((row[0], *kind), []).append(row)
    for rows in by_kind.values():
        reach = None
        for row in sorted(rows, key=lambda r: r[1] or FIRST_DAY):
            if reach is not None and (reach[2] or LAST_DAY) >= (row[1] or FIRST_DAY):
                found.append((reach, row))
            if reach is None or (row[2] or LAST_DAY) > (reach[2] or LAST_DAY):
                reach = row
    return found


def rate_overlaps(rates: DataFrame) -> DataFrame:
    """Rows of a rate table whose period overlaps an earlier one that is for the same loans."""
    kinds = rates.withColumn("_n", F.monotonically_increasing_id()).withColumns({
        "_ordinal": F.explode(F.when(F.col("ordinal") == "any", F.array(F.lit("first"), F.lit("later"))).otherwise(F.array("ordinal"))),
    }).withColumn(
        "_kind", F.explode(F.when(F.col("regular_only"), F.array(F.lit("regular"))).otherwise(F.array(F.lit("regular"), F.lit("refill"))))
    )
    found = audit_overlaps(kinds, ["rate_country", "_ordinal", "_kind"], "valid_from", "valid_until", "_n")
    return found.dropDuplicates(["_n"]).select(*rates.columns, "reaches")


def checked_rates(rates: DataFrame) -> DataFrame:
    """``rates`` where no two rows apply to one loan; otherwise an error, as the loan's row would be doubled."""
    clash = rate_overlaps(rates).first()
    if clash:
        raise ValueError(f"rates overlap: {clash.asDict()}")
    return rates


def rate_table(spark: SparkSession, rates=RATES) -> DataFrame:
    """The rate rows as literal SQL values, whose size Spark knows when it picks the join; overlapping ones are an error."""
    clashes = _clashes(rates)
    if clashes:
        raise ValueError(f"rates overlap: {clashes[0]}")

    def day(value: str | None) -> str:
        return f"date'{value}'" if value else "CAST(NULL AS DATE)"

    rows = ", ".join(
        f"({c}, {day(a)}, {day(b)}, '{o}', {str(r).lower()}, {x}D, {y}D, {z}D)"
        for c, a, b, o, r, x, y, z in rates
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS "
        "t(rate_country, valid_from, valid_until, ordinal, regular_only, in_term, late_60, late_90)"
    )


def loan_cycle(fin: DataFrame) -> DataFrame:
    """Adds the loan's ordinal within its user and its cycle label.

    Loans of one user on one day are ordered by a digest of ``financing_id``, whatever its type; those without
    a start date come first. A user's loans are numbered in cells of one day and two digits of the digest.
    """
    marked = fin.withColumn("_digest", F.md5(F.col("financing_id").cast("string").cast("binary")))
    cells = [F.col("start_date"), F.substring("_digest", 1, 2)]
    numbered = ranked(marked, ["user_id"], ["start_date", "_digest"], cells, "loan_num").drop("_digest")
    return numbered.withColumn("loan_num_status", cycle_label(F.col("financing_type"), F.col("loan_num")))


def last_collection(repayments: DataFrame, project: str) -> DataFrame:
    """Date of the newest repayment per loan for one project."""
    return (
        repayments.filter(F.col("project_name") == project)
        .groupBy("financing_id")
        .agg(F.to_date(F.max("repayment_created_at")).alias("last_collection_date"))
    )


def previous_day_rate(fin: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``usd_rate`` of the day before the last collection, or before the start without one.

    The day is computed first, so both join keys are equalities.
    """
    day = F.date_sub(F.coalesce("last_collection_date", "start_date"), 1)
    rate = rates.select("country_id", F.col("currency_dt_part").alias("_rate_day"), "usd_rate")
    return (
        fin.withColumn("_rate_day", day).join(rate, ["country_id", "_rate_day"], "left").drop("_rate_day")
    )


def usd_columns(df: DataFrame) -> DataFrame:
    """Five amounts in USD and the fee ratio, as doubles; a rate of zero is an error."""
    usd = {f"{out}_usd": F.col(c).cast("double") / F.col("usd_rate") for c, out in USD_AMOUNTS.items()}
    ratio = F.col("fga_fee").cast("double") / F.col("disbursed_amount").cast("double")
    return df.withColumns({**usd, "fga_rate": ratio})


def _percent(late: Column) -> Column:
    return (
        F.when(late <= 0, F.col("in_term")).when(late <= 60, F.col("late_60")).when(late <= 90, F.col("late_90"))
    )


def fee_share(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``percent_from_fee``: the rate of the agreement a paid loan falls under, else 0.

    The ladder of agreements is a small table joined on country with the dates and ordinal as
    residual, so a country holding most loans is not shuffled as one key. Pass rates of ``rate_table``, or others
    through ``checked_rates``: where two apply to a loan its row would be doubled.
    """
    kind = F.lower("financing_type")
    regular, refill = kind.contains("regular"), kind.contains("refill")
    first = F.col("loan_num") == 1
    applies = (
        (F.col("country_id") == F.col("rate_country"))
        & (F.col("valid_from").isNull() | (F.col("start_date") >= F.col("valid_from")))
        & (F.col("valid_until").isNull() | (F.col("start_date") <= F.col("valid_until")))
        & (F.col("financing_status") == "PAID")
        & (regular | (refill & ~F.col("regular_only")))
        & ((F.col("ordinal") == "any") | (first == (F.col("ordinal") == "first")))
    )
    percent = _percent(days_late(F.col("due_date"), F.col("last_collection_date")))
    return (
        df.join(rates, applies, "left")
        .withColumn("percent_from_fee", F.coalesce(percent, F.lit(0.0)))
        .drop(*rates.columns)
    )


def revenue(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``percent_from_fee``, ``revenue_local`` and ``revenue_usd``.

    Countries with VAT in the fee take the share of the fee net of VAT. The others take it of the
    offer's fee, or the historical offer's, as it stands; without either, revenue is NULL.
    """
    shared = fee_share(df, rates)
    country, percent = F.col("country_id"), F.col("percent_from_fee")
    gross = F.lit(None).cast("int")
    for code in VAT_INCLUDED:
        gross = F.when(country == code, F.lit(100 + int(VAT[code][2:]))).otherwise(gross)
    fraction = percent / F.lit(100.0)
    net = F.col("interest_amount").cast("double") * fraction * F.lit(100) / gross
    plain = F.coalesce("offer_interest_amount", "offer_fixed_fee").cast("double") * fraction
    local = F.when(percent == 0, F.lit(0.0)).when(gross.isNotNull(), net).otherwise(plain)
    return shared.withColumn("revenue_local", local).withColumn(
        "revenue_usd", F.when(percent == 0, F.lit(0.0)).otherwise(F.col("revenue_local") / F.col("usd_rate"))
    )
