"""Every registered query against its SQL, and the plans that matter at scale."""

import os
import re

import pytest

import __spark_entry__ as entry
from checks import catalog
from ledgerloom.operators import partitioning
from tests.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
QUERIES = {name: q for name, q in entry.queries().items() if name in catalog.all_queries()}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    mine = QUERIES[name](spark, SF).toArrow()
    assert mine.num_rows > 0
    assert compare(mine, con.sql(ORACLES[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", ["loan_day_report", "rebuild_payments", "revenue_snapshot_day", "ingest_attributes"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
    try:
        assert compare(QUERIES[name](spark, SF).toArrow(), con.sql(ORACLES[name]).to_arrow_table()) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("name", ["loan_day_report", "revenue_snapshot_day", "form_fields", "attributes_with_expiry"])
def test_queries_run_when_nothing_is_small_enough_to_broadcast(spark, con, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastNestedLoopJoin" not in plan(spark, name)
        assert compare(QUERIES[name](spark, SF).toArrow(), con.sql(ORACLES[name]).to_arrow_table()) == ""
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text, bad


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "daily_totals")
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert {frozenset(r) for r in read} == {
        frozenset({"l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"}), frozenset({"o_orderkey", "o_orderdate"}),
    }


def test_partition_filters_reach_the_balance_scan(spark, tmp_path):
    from ledgerloom.operators import accrual
    from checks.bindings import Bindings
    from checks.catalog import open_balances_policy
    from ledgerloom.operators.payments import daily_totals
    from ledgerloom.sources.tables import write_partitions

    b = Bindings(spark, SF)
    path = str(tmp_path / "balances")
    assert write_partitions(open_balances_policy(b), path, "balance_date") > 0
    report = accrual.loan_day_report(
        b.loans(), b.products_policy(), b.offers(), b.terms(), daily_totals(b.payments()),
        spark.read.parquet(path), "2025-03-01", "2025-03-05",
    )
    text = report._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*balance_date[^\]]*2025-03-01", text)


def test_cycle_number_is_one_window(spark):
    assert plan(spark, "revenue_snapshot_day").count("row_number()") == 1


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 12


@pytest.mark.parametrize("name", ["loan_day_report", "loan_day_report_fixed"])
def test_report_days_come_after_the_last_shuffle(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        above = plan(spark, name).split("explode(")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Generate" in above and "Exchange" not in above and "Sort" not in above


def test_stored_days_are_sorted_once_and_before_they_meet_their_loan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "loan_day_report_stored")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, _, below = text.partition("SortMergeJoin")
    for step in ("Sort ", "Window ", "Exchange"):
        assert step not in above, step
    assert re.search(r"hashpartitioning\(_loan#\d+L, \d+\), REPARTITION_BY_NUM", below)


def test_payments_are_read_by_loan_in_partitions_that_are_not_merged(spark):
    text = plan(spark, "daily_totals")
    assert "REPARTITION_BY_NUM" in text and "hashpartitioning(l_orderkey" in text
    assert "ENSURE_REQUIREMENTS" not in text.split("REPARTITION_BY_NUM")[0].split("HashAggregate")[-1]


def test_contract_payments_are_read_by_loan_in_partitions_that_are_not_merged(spark):
    text = plan(spark, "recalculate_schedule")
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, \d+\), REPARTITION_BY_NUM", text)
    # dealt once: the sums of days find the rows by their loan already
    assert text.count("REPARTITION_BY_NUM") == 1


def test_partitions_by_loan_grow_with_the_rows(spark):
    rows = spark.range(10).selectExpr("id AS loan_id")
    for n, parts in ((0, 4), (10, 4), (4 * partitioning.PARTITION_ROWS, 4), (40 * partitioning.PARTITION_ROWS + 1, 41)):
        assert partitioning.by_key(rows, "loan_id", n).rdd.getNumPartitions() == parts


def test_one_day_is_rolled_without_another_shuffle_of_payments(spark, monkeypatch):
    """More partitions than the session has show who follows the payments' number: all that meets them by loan."""
    monkeypatch.setattr(partitioning, "PARTITION_ROWS", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("catch_up_balances", "roll_one_day"):
            text = plan(spark, name)
            many = set(re.findall(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\), REPARTITION_BY_NUM", text))
            assert len(many) == 1 and int(*many) > 4
            assert re.search(rf"hashpartitioning\(o_orderkey#\d+L?, {int(*many)}\), ENSURE_REQUIREMENTS", text)
            # neither payments nor balances are dealt by loan and day
            assert not re.search(r"hashpartitioning\(loan_id#\d+L?, \w+#\d+", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_balances_are_caught_up_over_payments_read_by_loan(spark):
    text = plan(spark, "catch_up_balances")
    dealt = re.findall(r"hashpartitioning\(l_orderkey#\d+L?, \d+\), (\w+)", text)
    assert dealt and set(dealt) == {"REPARTITION_BY_NUM"}
