"""The stored jobs end to end on the raw stand-ins, and what their logs say."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.clean import SQL as CLEAN_SQL
from checks.clean import rows
from checks.common import Registry, m, tidy
from checks.dims import FACT_SQL, SOURCES, keyed_sql
from checks.gold import SQL as GOLD_SQL
from checks.mapping import CALENDAR, Tables, with_tables
from tarnlake.plans import gold, jobs
from tarnlake.session import fresh_folder

CLEAN = {n: rows(n) for n in CLEAN_SQL}
CLEAN["clean_hr_employee"] = "SELECT businessentityid AS EmployeeID FROM humanresources_employee"
SALES = [n for n in CLEAN if n in (
    "clean_sales_order_header", "clean_sales_order_detail", "clean_sales_currency_rate", "clean_sales_currency",
    "clean_sales_customer", "clean_person", "clean_sales_store", "clean_person_address", "clean_production",
    "clean_purchasing_vendor", "clean_sales_territory")]
FACTS = {"fact_sales_order": "new_orders", "fact_sales_order_detail": "new_details", "fact_purchases": "new_purchases"}


def run(spark, sf_dir: str) -> str:
    """All three jobs, the model part twice; returns the folder."""
    root = fresh_folder(spark, "lake")
    jobs.clean_job(spark, Tables(spark, sf_dir), root, "day1")
    for day in ("day1", "day2"):
        jobs.dimension_job(spark, root, day, CALENDAR)
        jobs.fact_job(spark, root, day)
    return root


def lineage(spark, sf_dir: str):
    log = spark.read.parquet(jobs.log_path(run(spark, sf_dir), "data_lineage"))
    return log.select("RunID", "ProcessName", "TableSaved", "QtyRead", "QtyWritten", "Status")


def lake_margins(spark, sf_dir: str):
    """Profit per year and category from a stored star schema: the sales tables, once."""
    root = fresh_folder(spark, "lake")
    jobs.clean_job(spark, Tables(spark, sf_dir), root, "day1", SALES)
    jobs.dimension_job(spark, root, "day1", CALENDAR)
    jobs.fact_job(spark, root, "day1", ("fact_sales_order", "fact_sales_order_detail"))
    prof = gold.profitability(jobs.star(spark, root))
    return tidy(prof.groupBy("Year", "Category").agg(F.sum("Revenue").alias("Revenue"), F.sum("Profit").alias("Profit")))


def _lineage_sql() -> str:
    parts = [f"SELECT 'day1' AS RunID, 'clean' AS ProcessName, '{n}' AS TableSaved, count(*) AS n, count(*) AS w FROM {n}" for n in CLEAN]
    for name, sql in SOURCES.items():
        counted = f"SELECT '{{}}', 'dimensions', '{name}', count(*) + 1, {{}} FROM ({sql}) AS s"
        parts += [counted.format("day1", "count(*) + 1"), counted.format("day2", "0")]
    parts += [f"SELECT '{d}', 'dimensions', 'dim_date', count(*), count(*) FROM dim_date" for d in ("day1", "day2")]
    for name, new in FACTS.items():
        parts += [f"SELECT 'day1', 'facts', '{name}', count(*), count(*) FROM {new}", f"SELECT 'day2', 'facts', '{name}', count(*), 0 FROM {new}"]
    return f"SELECT RunID, ProcessName, TableSaved, n AS QtyRead, w AS QtyWritten, 'SUCCESS' AS Status FROM ({' UNION ALL '.join(parts)}) AS p"


def register(reg: Registry) -> None:
    tables = {**CLEAN, **keyed_sql(), **FACT_SQL}
    reg.add("h06_job_lineage", lineage, with_tables(_lineage_sql(), tables))
    unknown = {
        "fact_sales_order_detail": "SELECT * FROM new_details", "fact_sales_order": "SELECT * FROM new_orders",
        "dim_product": "SELECT * FROM keyed_dim_product UNION ALL SELECT -1, -1, 'Not registered', 'Not registered', 'Not registered', 'Not registered', 0, 0, 0",
        "dim_location": "SELECT Location_SK, CountryName, StateProvinceName FROM keyed_dim_location UNION ALL SELECT -1, 'Not registered', 'Not registered'",
        "dim_currency": "SELECT Currency_SK, ToCurrencyCode FROM keyed_dim_currency UNION ALL SELECT -1, 'UNK'",
        "dim_territory": "SELECT Territory_SK, TerritoryName, TerritoryGroup FROM keyed_dim_territory UNION ALL SELECT -1, 'Not registered', 'Not registered'",
    }
    reg.add("f01_profit_of_stored_star", lake_margins, with_tables(
        f"SELECT Year, Category, {m('sum(Revenue)', 'Revenue')}, {m('sum(Profit)', 'Profit')} FROM profitability GROUP BY ALL",
        {**tables, **GOLD_SQL, **unknown}))
