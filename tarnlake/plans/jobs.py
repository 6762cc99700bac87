"""The daily data jobs over stored tables: clean, dimensions, facts.

Each table is written as its next version, checked as written and logged. A table that
fails gets a FAIL row and the next one goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.audit import lineage_row
from tarnlake.operators.merge import ACTION
from tarnlake.operators.rules import apply_rules
from tarnlake.plans import dims, facts
from tarnlake.plans.clean_tables import SPECS, clean_table
from tarnlake.plans.rulebooks import silver_rules
from tarnlake.session import checkpointed, shared_folder
from tarnlake.sinks import tables as sink
from tarnlake.sinks.ranges import exists, read_ranges

# Dimension -> (rows from cleaned tables, the cleaned tables it reads).
DIMENSION_SOURCES = {
    "dim_currency": (dims.currency_source, ("clean_sales_currency_rate", "clean_sales_currency")),
    "dim_customer": (dims.customer_source, ("clean_sales_customer", "clean_person", "clean_sales_store")),
    "dim_location": (dims.location_source, ("clean_person_address",)),
    "dim_product": (dims.product_source, ("clean_production",)),
    "dim_supplier": (dims.supplier_source, ("clean_purchasing_vendor",)),
    "dim_territory": (dims.territory_source, ("clean_sales_territory",)),
}
CALENDAR = ("2010-01-01", "2025-12-31")
AT_ONCE = 4  # tables submitted at the same time


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/silver/{table}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = table_path(root, table)
    return read_ranges(spark, path, facts.FACT_KEYS[table]) if table in facts.FACT_KEYS else sink.read_current(spark, path)


def log_path(root: str, log: str) -> str:
    return f"{root.rstrip('/')}/governance/{log}"


def _store(
    spark: SparkSession, root: str, table: str, build: Callable[[], DataFrame], common: dict
) -> tuple[bool, DataFrame, DataFrame | None]:
    """Build and write one table; returns success, its lineage row and its checks. An
    upsert's tag column is counted while writing and left out; the lineage row tells
    inserted plus updated rows, and for facts the rows that the load brought."""
    start = datetime.now(timezone.utc)
    common = dict(common, layer="SILVER", table=table)
    try:
        df = build()
        if table in facts.FACT_KEYS:
            done = facts.upsert_fact(table, df, table_path(root, table))
            row = lineage_row(spark, start=start, read=done.read, written=done.changed.count(), **common)
            return True, row, apply_rules(read_table(spark, root, table), silver_rules(), **common)
        seen = Observation()
        changed = F.count(F.lit(1))
        if ACTION in df.columns:
            changed = F.count(F.when(F.col(ACTION) != "keep", 1))
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), changed.alias("changed"))
        sink.overwrite(counted.drop(ACTION), table_path(root, table))
        row = lineage_row(spark, start=start, read=seen.get["rows"], written=seen.get["changed"], **common)
        return True, row, apply_rules(read_table(spark, root, table), silver_rules(), **common)
    except Exception as error:
        return False, lineage_row(spark, start=start, status="FAIL", error=error, **common), None


def store_all(
    spark: SparkSession, root: str, builds: Mapping[str, Callable[[], DataFrame]], *, run_id: str, process: str
) -> list[str]:
    """Store independent tables, a few at a time so that small ones do not leave the
    cluster idle, then log them together: one small write per log and job. A table's checks
    run as soon as it is stored, so that their shuffles are not on disk for all tables at once. Returns the failed."""
    common = dict(run_id=run_id, process=process)

    def stored(item) -> tuple[bool, DataFrame, DataFrame | None]:
        good, row, checks = _store(spark, root, *item, common)
        return good, row, checks if checks is None else checkpointed(checks)

    shared_folder(spark)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        results = pool.map(stored, builds.items())
        done = dict(zip(builds, results))
    logs = {
        "data_lineage": [row for _, row, _ in done.values()],
        "data_quality": [checks for _, _, checks in done.values() if checks is not None],
    }
    for log, parts in logs.items():
        if parts:
            reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("append").parquet(log_path(root, log))
    return [t for t, (good, _, _) in done.items() if not good]


def clean_job(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, run_id: str, names: Iterable[str] = tuple(SPECS)
) -> list[str]:
    """Raw to cleaned tables; returns those that failed."""
    builds = {n: lambda n=n: clean_table(n, raw) for n in names}
    return store_all(spark, root, builds, run_id=run_id, process="clean")


def _current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    path = table_path(root, table)
    there = exists(spark, path) if table in facts.FACT_KEYS else sink.current_path(spark, path)
    return read_table(spark, root, table) if there else None


def dimension_job(
    spark: SparkSession, root: str, run_id: str, calendar: tuple[str, str] | None = None, failed: Iterable[str] = ()
) -> list[str]:
    """Cleaned tables to the next version of every dimension. Without ``calendar`` the days of the stored orders are
    covered; a dimension that reads a ``failed`` table is not built."""
    def build(name: str) -> DataFrame:
        if name == "dim_date":
            return dims.dim_date(spark, *(calendar or covered_days(spark, root)))
        make, needed = DIMENSION_SOURCES[name]
        _needs(needed, failed)
        source = make(*[read_table(spark, root, t) for t in needed])
        return dims.load_dimension(name, source, _current(spark, root, name))

    builds = {n: lambda n=n: build(n) for n in (*DIMENSION_SOURCES, "dim_date")}
    return store_all(spark, root, builds, run_id=run_id, process="dimensions")


def covered_days(spark: SparkSession, root: str) -> tuple[str, str]:
    """First and last day of the calendar: the usual range, widened to every stored order and ship date."""
    first, last = CALENDAR
    for table in ("clean_sales_order_header", "clean_purchasing_order"):
        if (df := _current(spark, root, table)) is not None:
            days = df.select(F.explode(F.array(F.to_date("OrderDate"), F.to_date("ShipDate"))).alias("d"))
            low, high = days.agg(F.date_format(F.min("d"), "yyyy-MM-dd"), F.date_format(F.max("d"), "yyyy-MM-dd")).first()
            first, last = min(first, low or first), max(last, high or last)
    return first, last


def _needs(tables: Iterable[str], failed: Iterable[str]) -> None:
    missing = sorted(set(tables) & set(failed))
    if missing:
        raise RuntimeError(f"skipped: {', '.join(missing)} failed in this run")


# Fact -> the tables whose failure it cannot do without.
FACT_NEEDS = {
    "fact_sales_order": (
        "clean_sales_order_header", "dim_customer", "dim_currency", "dim_location", "dim_territory", "dim_date"),
    "fact_sales_order_detail": ("clean_sales_order_detail", "dim_product"),
    "fact_purchases": (
        "clean_purchasing_order_line", "clean_purchasing_order", "dim_supplier", "dim_product", "dim_date"),
}


def fact_job(
    spark: SparkSession, root: str, run_id: str, names: Iterable[str] = tuple(facts.FACT_KEYS), failed: Iterable[str] = ()
) -> list[str]:
    """Cleaned tables and dimensions into the key-range files of every fact. A fact that reads a ``failed`` table is not
    built on yesterday's keys; its log row says why."""
    def read(table: str) -> DataFrame:
        return read_table(spark, root, table)

    def source(name: str) -> DataFrame:
        if name == "fact_sales_order_detail":
            return facts.fact_sales_order_detail(read("clean_sales_order_detail"), read("dim_product"))
        members = {n: read(n) for n in (*DIMENSION_SOURCES, "dim_date")}
        if name == "fact_sales_order":
            return facts.fact_sales_order(read("clean_sales_order_header"), members)
        return facts.fact_purchases(
            read("clean_purchasing_order_line"), read("clean_purchasing_order"), members)

    def build(name: str) -> DataFrame:
        _needs(FACT_NEEDS[name], failed)
        return source(name)

    builds = {n: lambda n=n: build(n) for n in names}
    return store_all(spark, root, builds, run_id=run_id, process="facts")


def star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored star schema, as the gold, feature and measure plans take it."""
    names = (*DIMENSION_SOURCES, "dim_date", *facts.FACT_KEYS)
    return {n: df for n in names if (df := _current(spark, root, n)) is not None}
