"""Registered queries against their SQL on the smallest tables.

By default a selection that touches every module; TARNLAKE_ALL=1 runs all of them.
"""

import os
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_points

FOLDER = Path("/root/testdata/sf0.001")
SOME = (
    "a01_ingest_json", "a06_latest_snapshot", "a16_not_landed", "b03_scd1_merge", "b04_merge_counts", "c00_deduplicate",
    "c08_clean_production", "c19_clean_sales_order_header", "c30_api_currency", "d03_dim_customer", "e01_fact_sales_order",
    "f01_profitability", "f04_purchases_for_bi", "g02_demand_product_monthly", "g04_insights_overview_daily",
    "g08_product_region_daily", "g10_customer_classification", "h02_duplicate_checks", "h08_run_state", "i04_total_profit",
    "i09_date_drill", "j08_seasonal_forecast", "a07_widened_raw_table", "b03_stored_merge", "f01_maintained_profitability",
    "g01_refreshed_demand_daily", "g06_refreshed_customer_daily", "h04_all_raw_rules", "j02_forest_splits", "j05_feature_importance",
)
OWN = re.compile(r"[a-j]\d\d_")  # queries of the inventory; others come and go with their subpackage
NAMES = [n for n in entry_points.oracle_sql() if OWN.match(n)] if os.environ.get("TARNLAKE_ALL") else SOME
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    from tools.check import compare

    df = entry_points.queries()[name](spark, str(FOLDER))
    _, problems = compare(duck, name, df, entry_points.oracle_sql()[name])
    assert problems == []


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["OrderDate", "Year", "Month"] and df.limit(1).count() == 1


def test_every_sql_has_a_query():
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(queries)
    assert {n for n in queries if OWN.match(n)} <= set(oracles)


def test_every_operator_has_a_query():
    have = {n[:3] for n in entry_points.queries() if OWN.match(n)}
    counts = {"a": range(1, 18), "b": range(1, 10), "c": range(0, 32), "d": range(1, 9), "e": range(1, 4),
              "f": range(1, 19), "g": range(1, 18), "h": range(1, 17), "i": range(1, 13), "j": range(1, 9)}
    assert have == {f"{k}{n:02d}" for k, ns in counts.items() for n in ns}


@pytest.mark.parametrize("name", ["f01_profitability", "g01_demand_product_daily", "e03_fact_purchases", "i08_drill_table"])
def test_plans_have_no_nested_loops_and_read_few_columns(spark, name):
    plan = entry_points.queries()[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?customer.parquet", plan)
    assert all("c_acctbal" not in s for s in scans)


def test_tasks_read_bounded_splits_and_partitions(spark):
    """A task's memory must not grow with the table: splits and shuffle partitions are bounded, smaller bounds stay."""
    from tarnlake.session import TABLE_PARTITIONS, tune

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    first, kept = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "128MB")
        tune(spark, TABLE_PARTITIONS)
        assert [int(spark.conf.get(n)) >> 20 for n in names] == [32, 16] and int(spark.conf.get(first)) == TABLE_PARTITIONS
        spark.conf.set(names[0], "1m")
        tune(spark)
        assert spark.conf.get(names[0]) == "1m" and spark.conf.get(first) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        for n, value in kept.items():
            spark.conf.set(n, value)
