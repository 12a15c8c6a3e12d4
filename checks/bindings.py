"""Domain frames derived from the test tables (FIXTURES.md, part 3).

``bindings_sql.py`` states the same frames as SQL for the oracle.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import seeds
from ledgerloom.functions.arith import money
from ledgerloom.operators.partitioning import by_key
from ledgerloom.sources.tables import read_table

PROJECT = "PARTNER"


def _values(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


class Bindings:
    """Lazy domain frames over one directory of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    @functools.cached_property
    def _line_count(self) -> int:
        """From the footers of the files."""
        return self.table("lineitem").count()

    # -- accrual mart -------------------------------------------------------------------------

    def products_flat(self) -> DataFrame:
        return _values(self.spark, seeds.PRODUCTS_FLAT, seeds.PRODUCTS_FLAT_COLUMNS)

    def products_policy(self) -> DataFrame:
        return _values(self.spark, seeds.PRODUCTS_POLICY, seeds.PRODUCTS_POLICY_COLUMNS)

    def terms(self) -> DataFrame:
        return _values(self.spark, seeds.TERMS, seeds.TERMS_COLUMNS)

    @staticmethod
    def _opened() -> Column:
        day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 90
        return F.date_add(F.lit("2025-01-01").cast("date"), day)

    def loans(self) -> DataFrame:
        opened = self._opened()
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            (F.lit(2001) + F.col("o_custkey") % 5).cast("int").alias("product_id"),
            F.col("o_orderkey").alias("offer_id"),
            F.when(F.col("o_orderstatus") == "O", "ACTIVE")
            .when(F.col("o_orderstatus") == "F", "PAID")
            .otherwise("DEFAULT").alias("status"),
            opened.cast("timestamp_ntz").alias("open_dttm"),
            F.date_add(opened, 124).cast("timestamp_ntz").alias("due_dttm"),
            F.lit(None).cast("timestamp_ntz").alias("close_dttm"),
        )

    def loan_batch(self) -> DataFrame:
        """Urgent orders come again as a batch of active loans."""
        urgent = self.table("orders").filter(F.col("o_orderpriority") == "1-URGENT")
        batch = self.loans().join(urgent.select(F.col("o_orderkey").alias("id")), "id", "left_semi")
        return batch.withColumn("status", F.lit("ACTIVE"))

    def offers(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            (F.lit(2001) + F.col("o_custkey") % 5).cast("int").alias("product_id"),
            F.floor("o_totalprice").cast("int").alias("approved_amount"),
            F.when(F.col("o_orderstatus") == "O", "ACTIVE").otherwise("EXPIRED").alias("status"),
        )

    def low_priority_offers(self) -> DataFrame:
        """Offers of low-priority orders only, so that some loans have none."""
        low = self.table("orders").filter(F.col("o_orderpriority") == "5-LOW")
        return self.offers().join(low.select(F.col("o_orderkey").alias("id")), "id", "left_semi")

    def _payment_rows(self, lines: DataFrame | None = None) -> DataFrame:
        opened = self.table("orders").select("o_orderkey", self._opened().alias("opened"))
        if lines is None:
            lines = self.table("lineitem")
        else:  # dealt by order already: with the orders hashed they need no sort either
            opened = opened.hint("shuffle_hash")
        days = (F.col("l_partkey") % 120 + 1).cast("int")
        minutes = (F.col("l_suppkey") % 1440).cast("int")
        paid_on = F.date_add("opened", days).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)
        return (
            lines
            .join(opened, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
                F.col("l_orderkey").alias("loan_id"),
                F.when(F.col("l_returnflag") == "N", "ride_payment").otherwise("direct_payment").alias("source"),
                paid_on.alias("payment_dttm"),
                F.floor(F.col("l_extendedprice") / 4).cast("int").alias("payment_amount"),
                "l_returnflag",
            )
        )

    def payments(self, spread: int = 1) -> DataFrame:
        """By loan, in ``spread`` times as many partitions as their lines ask for where many rows follow from each."""
        lines = by_key(self.table("lineitem"), "l_orderkey", self._line_count * spread)
        return self._payment_rows(lines).drop("l_returnflag")

    def by_loan(self, rows: DataFrame, spread: int = 1) -> DataFrame:
        """Rows dealt by loan as ``payments`` are: with what follows from those they meet and unite without a shuffle."""
        return by_key(rows, "loan_id", self._line_count * spread)

    def payments_as_read(self) -> DataFrame:
        """The same rows, for what meets them by their id first."""
        return self._payment_rows().drop("l_returnflag")

    def settled_payments(self) -> DataFrame:
        """Table side of the payment upserts."""
        return self._payment_rows().filter(F.col("l_returnflag") != "R").drop("l_returnflag")

    def staged_payments(self) -> DataFrame:
        """Incoming side: some ids are new, some come again with another amount."""
        staged = self._payment_rows().filter(F.col("l_returnflag") != "N").drop("l_returnflag")
        return staged.withColumn("payment_amount", F.col("payment_amount") + 1)

    def wide_terms(self) -> DataFrame:
        """A policy document per part."""
        size, key = F.col("p_size"), F.col("p_partkey")
        config = F.to_json(
            F.struct(
                (size + 1).alias("periods"),
                (key % 31 + 1).alias("period_length"),
                (size % 30 + 20).alias("total_interest_rate"),
                F.lit("open_principal").alias("interest_on"),
            )
        )
        return self.table("part").select(
            key.alias("id"), F.col("p_name").alias("policy_name"), F.lit("ACTIVE").alias("status"),
            config.alias("policy_config"),
        )

    # -- contracts ----------------------------------------------------------------------------

    def contract_loans(self) -> DataFrame:
        cust = F.col("o_custkey")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            money(F.col("o_totalprice")).alias("amount"),
            F.when(cust % 2 == 0, 10).otherwise(16).cast("decimal(5,2)").alias("interest_rate"),
            F.when(cust % 4 < 2, 4).otherwise(8).alias("term_months"),
            F.to_date("o_orderdate").alias("start_date"),
            F.when(F.col("o_orderstatus") == "P", "overdue").otherwise("active").alias("status"),
        )

    def contract_payments(self) -> DataFrame:
        start = self.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("start"))
        return (
            by_key(self.table("lineitem"), "l_orderkey")
            .join(start, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("loan_id"),
                F.date_add("start", (F.col("l_partkey") % 150).cast("int")).alias("payment_date"),
                money(F.col("l_extendedprice")).alias("payment_amount"),
            )
        )

    # -- revenue ------------------------------------------------------------------------------

    def fin(self) -> DataFrame:
        region = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_regionkey")
        )
        key = F.col("o_orderkey")
        country = (
            F.when(F.col("n_regionkey") == 0, 12).when(F.col("n_regionkey") == 1, 22)
            .when(F.col("n_regionkey") == 2, 24).otherwise(99)
        )
        kind = F.floor(key / 4) % 4
        start = F.date_add(F.to_date("o_orderdate"), 9000)
        rows = (
            self.table("orders")
            .join(region, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                key.alias("financing_id"),
                (F.col("o_custkey") * 4 + key % 4).alias("user_id"),
                country.alias("country_id"),
                F.concat(F.lit("country_"), country.cast("string")).alias("country_name"),
                key.alias("offer_id"),
                F.when(F.col("o_orderpriority") == "5-LOW", "OTHER").otherwise(PROJECT).alias("project_name"),
                F.when(F.col("o_orderstatus") == "F", "PAID")
                .when(F.col("o_orderstatus") == "O", "DEFAULT")
                .when(key % 3 == 0, "PAUSE").when(key % 3 == 1, "CANCELED").otherwise("WRITE-OFF")
                .alias("financing_status"),
                F.when(kind == 2, "REFILL").when(kind == 3, "regular").otherwise("REGULAR").alias("financing_type"),
                start.alias("start_date"),
                F.date_add(start, 124).alias("due_date"),
                (key % 20 + 10).cast("int").alias("repayment_rate"),
                money(F.col("o_totalprice")).alias("disbursed_amount"),
            )
        )
        disbursed = F.col("disbursed_amount")
        interest = money(F.round(disbursed * F.lit("0.10").cast("decimal(3,2)"), 2))
        fee = money(F.round(disbursed * F.lit("0.02").cast("decimal(3,2)"), 2))
        refill = F.col("financing_type") == "REFILL"
        return (
            rows.withColumns({"interest_amount": interest, "fga_fee": fee, "status": F.col("financing_status")})
            .withColumn("total_repayment_amount", money(disbursed + F.col("interest_amount")))
            .withColumn(
                "paid_amount",
                money(F.when(F.col("financing_status") == "PAID", F.col("total_repayment_amount")).otherwise(F.lit(0))),
            )
            .withColumn("parent_financing_id", F.when(refill, F.col("financing_id") - 1))
            .withColumn("refill_amount", F.when(refill, F.col("interest_amount")))
        )

    def drivers(self) -> DataFrame:
        user = (F.col("o_custkey") * 4 + F.col("o_orderkey") % 4).alias("dwh_driver_id")
        return self.table("orders").select(user).distinct().withColumn(
            "driver_id", F.col("dwh_driver_id") + 1000000
        )

    def _fee_offers(self, priorities: list[str], share: str, name: str) -> DataFrame:
        fee = F.round(money(F.col("o_totalprice")) * F.lit(share).cast("decimal(3,2)"), 2)
        return self.table("orders").filter(F.col("o_orderpriority").isin(priorities)).select(
            F.col("o_orderkey").alias("offer_id"), money(fee).alias(name)
        )

    def fee_offers(self) -> DataFrame:
        return self._fee_offers(["1-URGENT", "2-HIGH"], "0.12", "interest_amount")

    def historical_offers(self) -> DataFrame:
        return self._fee_offers(["2-HIGH", "3-MEDIUM"], "0.11", "fixed_fee")

    def collections(self) -> DataFrame:
        start = self.table("orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 9000).alias("start"))
        days = (F.col("l_partkey") % 260).cast("int")
        minutes = (F.col("l_suppkey") % 1440).cast("int")
        return (
            self.table("lineitem")
            .join(start, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("financing_id"),
                (F.date_add("start", days).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)).alias(
                    "repayment_created_at"
                ),
                F.when(F.col("l_returnflag") == "N", "OTHER").otherwise(PROJECT).alias("project_name"),
            )
        )

    def currency(self) -> DataFrame:
        """A rate per country and day; none on New Year's Day."""
        number = F.datediff("currency_dt_part", F.lit("1970-01-01").cast("date"))
        return (
            _values(self.spark, "(12), (22), (24), (99)", "country_id")
            .withColumn(
                "currency_dt_part",
                F.explode(F.sequence(F.lit("2019-08-01").cast("date"), F.lit("2027-01-01").cast("date"))),
            )
            .filter(F.date_format("currency_dt_part", "MM-dd") != "01-01")
            .withColumn("usd_rate", ((number * 7 + F.col("country_id")) % 100 + 100).cast("double") / F.lit(100.0))
        )

    # -- forms and attributes -----------------------------------------------------------------

    def form_products(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("product_id")).distinct().withColumn(
            "product_name", F.concat(F.lit("form "), "product_id")
        )

    def windows(self) -> DataFrame:
        return self.table("part").select(F.col("p_type").alias("window_id")).distinct().select(
            "window_id",
            F.concat(F.lit("window "), "window_id").alias("window_name"),
            (F.col("window_id") != "LARGE").alias("is_active"),
        )

    def fields(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("field_id"),
            F.concat_ws("#", "p_name", "p_partkey").alias("field_name"),
            (F.col("p_size") > 5).alias("is_active"),
        )

    def product_windows(self) -> DataFrame:
        return self.table("part").groupBy(
            F.col("p_brand").alias("product_id"), F.col("p_type").alias("window_id")
        ).agg(F.min("p_partkey").alias("display_order"))

    def window_fields(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("window_id"),
            F.col("p_partkey").alias("field_id"),
            F.col("p_partkey").alias("display_order"),
        )

    def patches(self) -> DataFrame:
        kind = F.col("event_type")
        count = F.regexp_extract("props", "([0-9]+)", 1)
        return self.table("events").select(
            F.col("user_id").alias("application_id"),
            F.col("ts").alias("seq"),
            F.to_json(F.create_map(kind, count, F.lit("newest"), kind)).alias("patch"),
            F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3).alias("window_id"),
            F.when(kind == "purchase", "COMPLETED").when(kind == "signup", "IN_PROGRESS").alias("status"),
        )

    def typed_patches(self) -> DataFrame:
        """Patches whose values are numbers, text, booleans, nested objects and null, by kind of event."""
        kind, count = F.col("event_type"), F.regexp_extract("props", "([0-9]+)", 1)
        value = (
            F.when(kind == "view", count)
            .when(kind == "click", F.concat(F.lit('"'), count, F.lit('"')))
            .when(kind == "purchase", F.when(count.cast("int") % 2 == 0, "true").otherwise("false"))
            .when(kind == "signup", F.concat(F.lit('{"at":{"n":'), count, F.lit('},"tags":["a",'), count, F.lit(",null]}")))
            .otherwise("null")
        )
        newest = F.concat(F.lit(', "newest": {"kind": "'), kind, F.lit('"}}'))
        return self.table("events").select(
            F.col("user_id").alias("application_id"),
            F.col("ts").alias("seq"),
            F.concat(F.lit('{"'), kind, F.lit('": '), value, newest).alias("patch"),
            F.when(kind == "signup", F.col("user_id") % 3 + 1).cast("int").alias("product_id"),
            F.when(kind.isin("signup", "view"), F.concat(F.lit("client "), F.col("user_id").cast("string"))).alias("client_id"),
            F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3).alias("window_id"),
            F.when(kind == "purchase", "COMPLETED").when(kind == "signup", "IN_PROGRESS").alias("status"),
        )

    def incoming(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.when(kind == "purchase", "partner_API").when(kind == "error", "unlisted").otherwise("service_db")
            .alias("source_name"),
            F.col("user_id").cast("string").alias("user_id"),
            kind.alias("attr_name"),
            F.regexp_extract("props", "([0-9]+)", 1).alias("value"),
            F.col("ts").alias("created_at"),
        )

    def sources(self) -> DataFrame:
        rows = "('service_db', 1), ('partner_API', 2)"
        return _values(self.spark, rows, "source_name, priority").withColumn(
            "id", F.md5(F.col("source_name").cast("binary"))
        )

    def attribute_meta(self) -> DataFrame:
        return self.table("events").select(F.col("event_type").alias("attr_name")).distinct().select(
            F.md5(F.col("attr_name").cast("binary")).alias("id"),
            "attr_name",
            (F.char_length("attr_name") * 30).alias("expiration_policy"),
            F.lit("string").alias("data_type"),
        )
