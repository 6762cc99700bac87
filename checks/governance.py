"""Quality checks, lineage and run-log reports."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.clean import SQL as CLEAN_SQL
from checks.clean import cleaned, rows
from checks.common import Registry, q, tidy
from checks.mapping import RAW as MAPPED_RAW
from checks.mapping import Tables, with_tables
from tarnlake.operators import audit, quality, rules
from tarnlake.plans import governance, rulebooks
from tarnlake.plans.clean_tables import SPECS
from tarnlake.session import fresh_folder
from tarnlake.sinks import tables as sink

NULL_COLUMNS = ("AddressID", "AddressLine2", "City", "PostalCode", "StateProvinceName", "SpatialLocation")
KEYS = (("l_orderkey",), ("l_partkey",), ("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_shipdate"))
# Every cleaned table; employees are read through an alias, so they are left to the job queries.
SILVER = tuple(n for n in CLEAN_SQL if n != "clean_hr_employee")
# Every raw table that is mapped and has a rule.
RAW_ALL = tuple(n for n in MAPPED_RAW if n in rulebooks.bronze_rules())
RAW = ("production_productinventory", "person_stateprovince", "csv_salesorderheader")


def lineage(t: Tables):
    """The log with its start and end times; a load lasts its event's whole seconds."""
    start = F.col("ts").cast("timestamp")
    return t["log_lineage"].withColumn("StartDate", F.date_trunc("second", start)).withColumn(
        "EndDate", F.timestamp_seconds(F.unix_timestamp("StartDate") + F.col("DurationSeconds")))


def run_log(t: Tables):
    """Each event starts a run; those that are no clicks also end it."""
    e, start = t["events"], F.col("ts").cast("timestamp")
    started = e.select(
        F.concat(F.lit("run-"), "event_id").alias("ADFRunID"), F.concat(F.lit("pipeline "), "event_type").alias("PipelineName"),
        F.concat(F.lit("t"), F.col("user_id") % 3).alias("TriggerName"), start.alias("TriggerTime"), start.alias("StartTime"),
        F.lit(None).cast("timestamp").alias("EndTime"), F.lit("STARTED").alias("Status"),
        F.lit(None).cast("string").alias("ErrorMessage"))
    ended = e.filter("event_type <> 'click'").select(
        F.concat(F.lit("run-"), "event_id").alias("ADFRunID"), F.lit(None).cast("string").alias("PipelineName"),
        F.lit(None).cast("string").alias("TriggerName"), F.lit(None).cast("timestamp").alias("TriggerTime"),
        F.lit(None).cast("timestamp").alias("StartTime"),
        F.timestamp_micros(F.unix_micros(start) + (F.floor("value") * 1000000).cast("long")).alias("EndTime"),
        F.when(F.col("event_type") == "error", "FAIL").otherwise("SUCCESS").alias("Status"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("code "), "props")).alias("ErrorMessage"))
    return started.unionByName(ended)


def states(t: Tables):
    """Run states, times in whole seconds since the epoch."""
    s = audit.run_state(run_log(t))
    return s.select(
        "ADFRunID", "PipelineName", "TriggerName", "Status", "ErrorMessage",
        *[F.unix_timestamp(c).alias(c) for c in ("TriggerTime", "StartTime", "EndTime")])


def null_report(spark, sf_dir: str):
    return quality.null_checks(cleaned(spark, sf_dir, "clean_person_address"), NULL_COLUMNS)


def duplicate_report(spark, sf_dir: str):
    return quality.duplicate_checks(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), KEYS)


def address_quality(spark, sf_dir: str):
    rows_ = quality.quality(
        cleaned(spark, sf_dir, "clean_person_address"), ["AddressID", "City"], ["AddressID", "City"],
        run_id="r1", process="clean", layer="SILVER", table="clean_person_address")
    return rows_.drop("CheckDate")


def raw_rules(spark, sf_dir: str):
    """Rules of a raw table, found in any case, with the ingestion columns it has."""
    book = {"Sales_Vendor": rules.Rule(("businessentityid", "accountnumber", "no_such_column"), ("businessentityid", "activeflag"))}
    raw = Tables(spark, sf_dir)["purchasing_vendor"].withColumn("FileSource", F.lit(" "))
    out = rules.apply_rules(raw, book, "SALES_vendor", layer="BRONZE", run_id="r1", process="ingest")
    return out.drop("CheckDate")


def derived_raw_rules(spark, sf_dir: str):
    """Rules derived for three raw tables: a base, a lookup and a headerless file."""
    t, book = Tables(spark, sf_dir), rulebooks.bronze_rules()
    parts = [
        rules.apply_rules(t[n], book, n, layer="BRONZE", run_id="r1", process="ingest").drop("CheckDate") for n in RAW
    ]
    return parts[0].union(parts[1]).union(parts[2])


def all_raw_rules(spark, sf_dir: str):
    """Every mapped raw table under its rule."""
    t, book = Tables(spark, sf_dir), rulebooks.bronze_rules()
    parts = [rules.apply_rules(t[n], book, n, layer="BRONZE", run_id="r1", process="ingest").drop("CheckDate") for n in RAW_ALL]
    return reduce(DataFrame.union, parts)


def _all_raw_sql() -> str:
    """The same rules, of those columns that a mapped table has."""
    parts, book = [], rulebooks.bronze_rules()
    for n in RAW_ALL:
        def there(columns, text=MAPPED_RAW[n]):
            return all(re.search(rf"\b{c}\b", text, re.IGNORECASE) for c in columns)

        keys = [(k,) if isinstance(k, str) else tuple(k) for k in book[n].check_dup]
        nulls = [_nulls(c, n) for c in book[n].check_null if there([c])]
        checks = nulls + [_dups(k, n) for k in keys if there(k)]
        if nulls:
            parts.append(_records("ingest", "BRONZE", n, checks))
    return " UNION ALL ".join(parts)


def silver_rules(spark, sf_dir: str):
    """Rules derived from the declarations of the cleaned tables."""
    made = {n: cleaned(spark, sf_dir, n) for n in SILVER}
    return rules.apply_rules_to_all(made, rulebooks.silver_rules(), layer="SILVER", run_id="r1", process="clean").drop("CheckDate")


def lineage_of_writes(spark, sf_dir: str):
    """Two writes to one path, so the second fails; their lineage rows without times."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    common = dict(run_id="r1", process="load", layer="SILVER")
    path = fresh_folder(spark, "lineage")
    good = audit.tracked_write(orders, lambda df: df.write.parquet(path), table="orders", **common)
    bad = audit.tracked_write(orders, lambda df: df.write.parquet(path), table="taken", **common)
    log = fresh_folder(spark, "log")
    sink.append(good, log)
    sink.append(bad, log)
    return spark.read.parquet(log).select(
        "RunID", "ProcessName", "Layer", "TableSaved", "QtyRead", "QtyWritten", "Status",
        F.col("ErrorMsg").contains("already exists").alias("ErrorKept"))


def _silver_sql() -> str:
    parts = []
    for n in SILVER:
        spec, keys = SPECS[n], ", ".join(SPECS[n].keys)
        for c in spec.required:
            parts.append(
                f"SELECT '{n}' AS TableName, '{c}' AS ColumnName, 'NULL' AS CheckType, count(*) AS TotalRows, "
                f"count_if({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')::BIGINT AS FailedRows FROM {n}")
        if keys:
            parts.append(
                f"SELECT '{n}' AS TableName, '{keys}' AS ColumnName, 'DUPLICATE' AS CheckType, count(*) AS TotalRows, "
                f"count(*) - count(DISTINCT ({keys})) AS FailedRows FROM {n}")
    return f"""SELECT 'r1' AS RunID, 'clean' AS ProcessName, TableName, ColumnName, 'SILVER' AS Layer, CheckType, TotalRows,
        FailedRows, CASE WHEN FailedRows = 0 THEN 'SUCCESS' ELSE 'FAIL' END AS Status FROM ({' UNION ALL '.join(parts)}) AS p"""


def _nulls(column: str, table: str) -> str:
    return (
        f"SELECT '{column}' AS ColumnName, 'NULL' AS CheckType, count(*) AS TotalRows, "
        f"count_if({column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '')::BIGINT AS FailedRows FROM {table}")


def _dups(columns, table: str) -> str:
    cols = ", ".join(columns)
    return (
        f"SELECT '{cols}' AS ColumnName, 'DUPLICATE' AS CheckType, (SELECT count(*) FROM {table}) AS TotalRows, "
        f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table}) AS d) AS FailedRows")


def _records(process: str, layer: str, table: str, checks: list[str]) -> str:
    return f"""SELECT 'r1' AS RunID, '{process}' AS ProcessName, '{table}' AS TableName, ColumnName, '{layer}' AS Layer,
        CheckType, TotalRows, FailedRows, CASE WHEN FailedRows = 0 THEN 'SUCCESS' ELSE 'FAIL' END AS Status
        FROM ({' UNION ALL '.join(checks)}) AS c"""


CLEAN = {n: rows(n) for n in ("clean_person_address", *SILVER)}
NOW = "2024-01-20 00:00:00"


def register(reg: Registry) -> None:
    def add(name: str, build: Callable, sql: str) -> None:
        reg.add(name, lambda s, d, b=build: tidy(b(Tables(s, d))), with_tables(sql, CLEAN))

    reg.add("h01_null_checks", null_report, with_tables(
        " UNION ALL ".join(_nulls(c, "clean_person_address") for c in NULL_COLUMNS), CLEAN))
    reg.add("h02_duplicate_checks", duplicate_report, " UNION ALL ".join(_dups(k, "lineitem") for k in KEYS))
    reg.add("h03_quality_records", address_quality, with_tables(_records(
        "clean", "SILVER", "clean_person_address",
        [_nulls(c, "clean_person_address") for c in ("AddressID", "City")]
        + [_dups([c], "clean_person_address") for c in ("AddressID", "City")]), CLEAN))
    reg.add("h04_raw_rules", raw_rules, with_tables(_records(
        "ingest", "BRONZE", "SALES_vendor",
        [_nulls(c, "marked") for c in ("businessentityid", "accountnumber", "FileSource")]
        + [_dups([c], "marked") for c in ("businessentityid", "activeflag")]),
        {"marked": "SELECT *, ' ' AS FileSource FROM purchasing_vendor"}))
    reg.add("h04_derived_raw_rules", derived_raw_rules, with_tables(" UNION ALL ".join(
        _records("ingest", "BRONZE", n, [*[_nulls(c, n) for c in nulls], *[_dups(k, n) for k in keys]])
        for n, nulls, keys in (
            (RAW[0], ("productid", "locationid"), [("productid", "locationid")]),
            (RAW[1], ("stateprovinceid",), [("stateprovinceid",)]),
            (RAW[2], ("_c0",), [])))))
    reg.add("h04_all_raw_rules", all_raw_rules, with_tables(_all_raw_sql()))
    reg.add("h05_silver_rules", silver_rules, with_tables(_silver_sql(), CLEAN))
    reg.add("h06_lineage_rows", lineage_of_writes, """
        SELECT 'r1' AS RunID, 'load' AS ProcessName, 'SILVER' AS Layer, 'orders' AS TableSaved, count(*) AS QtyRead,
          count(*) AS QtyWritten, 'SUCCESS' AS Status, NULL::BOOLEAN AS ErrorKept FROM orders
        UNION ALL SELECT 'r1', 'load', 'SILVER', 'taken', 0, 0, 'FAIL', true""")
    add("h08_run_state", states, """
        SELECT 'run-' || event_id AS ADFRunID, 'pipeline ' || event_type AS PipelineName, 't' || (user_id % 3) AS TriggerName,
          CASE event_type WHEN 'click' THEN 'STARTED' WHEN 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS Status,
          CASE WHEN event_type = 'error' THEN 'code ' || props END AS ErrorMessage,
          floor(epoch(ts))::BIGINT AS TriggerTime, floor(epoch(ts))::BIGINT AS StartTime,
          CASE WHEN event_type <> 'click' THEN floor(epoch(ts))::BIGINT + floor(value)::BIGINT END AS EndTime
        FROM events""")
    add("h09_mean_duration", lambda t: governance.mean_duration(lineage(t)),
        f"SELECT {q('avg(DurationSeconds)', 'AvgDurationSeconds')} FROM log_lineage")
    add("h10_failed_loads", lambda t: governance.failed_loads(lineage(t)),
        "SELECT count(*) AS FailedLoads FROM log_lineage WHERE Status = 'FAIL'")
    add("h11_recent_runs",
        lambda t: governance.recent_runs(run_log(t), F.lit(datetime.fromisoformat(NOW)).cast("timestamp")),
        f"""SELECT count(*) AS RecentRuns FROM events
            WHERE ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND TIMESTAMP '{NOW}'""")
    add("h12_failed_checks", lambda t: governance.failed_checks(t["log_quality"]),
        "SELECT TableName, CheckType, count(*) AS FailedChecks FROM log_quality WHERE Status = 'FAIL' GROUP BY ALL")
    add("h13_failed_rows", lambda t: governance.failed_rows(t["log_quality"]),
        """SELECT TableName, ColumnName, Layer, CheckType, sum(FailedRows)::BIGINT AS FailedRows,
             sum(TotalRows)::BIGINT AS TotalRows FROM log_quality WHERE Status = 'FAIL' GROUP BY ALL""")
    add("h14_load_by_table", lambda t: governance.load_by_table(lineage(t)),
        f"""SELECT TableSaved, sum(QtyRead)::BIGINT AS QtyRead, {q('avg(DurationSeconds)', 'AvgDurationSeconds')}
            FROM log_lineage GROUP BY ALL""")
    add("h15_log_calendar", lambda t: governance.by_log_day(t["log_lineage"], "LogDate"),
        """SELECT LogDate AS FullDate, count(*) AS LogRows, year(LogDate)::INT AS CalendarYear,
             month(LogDate)::INT AS MonthNumberOfYear, day(LogDate)::INT AS DayNumberOfMonth
           FROM log_lineage GROUP BY LogDate""")
    add("h16_failures", lambda t: governance.failures(lineage(t)).withColumn("StartDate", F.unix_timestamp("StartDate")),
        """SELECT ProcessName, Layer, TableSaved, floor(epoch(ts))::BIGINT AS StartDate, ErrorMsg
           FROM log_lineage WHERE Status = 'FAIL'""")
