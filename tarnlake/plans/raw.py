"""The raw-layer job: drain each landed table into its raw table, check this run's rows, log every table."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarnlake.operators.audit import lineage_row
from tarnlake.operators.rules import apply_rules
from tarnlake.plans.jobs import AT_ONCE, log_path
from tarnlake.plans.rulebooks import bronze_rules
from tarnlake.sources import registry
from tarnlake.sources.snapshots import list_files, snapshot_tables, unfinished
from tarnlake.streaming.ingest import IngestStats, ingest, this_run


# What ingestion adds to every row.
INGESTION = (
    T.StructField("IngestionDate", T.TimestampType()), T.StructField("FileSource", T.StringType()), T.StructField("IngestRunID", T.StringType()))


def raw_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/bronze/{table}"


def registry_path(root: str) -> str:
    return f"{root.rstrip('/')}/bronze/_columns"


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table with all columns any snapshot had, as the log of columns tells; no stored file is opened for it."""
    fields = registry.columns_of(spark, registry_path(root), table).fields
    if not fields:
        return spark.read.parquet(raw_path(root, table))
    return spark.read.schema(T.StructType([*fields, *INGESTION])).parquet(raw_path(root, table))


def landed(spark: SparkSession, landing: str) -> dict[str, list[str]]:
    """Table name -> its finished snapshots, oldest first; only names reach the driver."""
    found = snapshot_tables(list_files(spark, landing))
    open_ones = set(unfinished(spark, found))
    out: dict[str, list[str]] = {}
    for r in found.groupBy("table_name", "snapshot").agg({"modificationTime": "max"}).orderBy("max(modificationTime)", "snapshot").toLocalIterator():
        if r["snapshot"] not in open_ones:
            out.setdefault(r["table_name"], []).append(r["snapshot"])
    return out


def drain_snapshots(spark: SparkSession, snapshots: list[str], root: str, table: str, run_id: str) -> IngestStats:
    """Append the table's snapshots not seen before. Each table has its own checkpoint, columns may be new and types may
    grow; a change that loses values is refused before anything is read."""
    folder = snapshots[-1].rsplit("/", 1)[0]
    schema = registry.enter(spark, registry_path(root), table, snapshots, run_id)
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return ingest(
        spark, folder, "parquet", declared, f"{root.rstrip('/')}/bronze/_checkpoints/{table}", raw_path(root, table), run_id,
        options={"recursiveFileLookup": True})


def raw_job(spark: SparkSession, landing: str, root: str, run_id: str, tables: Iterable[str] | None = None) -> list[str]:
    """Drain every landed table (or the named ones); returns those that failed. A table that fails is logged and the
    next goes on."""
    found = landed(spark, landing)
    common = dict(run_id=run_id, process="raw", layer="BRONZE")
    rows, checks, failed = [], [], []

    def drain(table: str) -> tuple[str, DataFrame, DataFrame | None, bool]:
        start = datetime.now(timezone.utc)
        try:
            stats = drain_snapshots(spark, found[table], root, table, run_id)
            row = lineage_row(spark, start=start, read=stats.read, written=stats.written, table=table, **common)
            check = apply_rules(this_run(read_raw(spark, root, table), run_id), bronze_rules(), table=table, **common) if stats.written else None
            return table, row, check, True
        except Exception as error:
            return table, lineage_row(spark, start=start, status="FAIL", error=error, table=table, **common), None, False

    # A few tables at once, so that small ones do not leave the cluster idle.
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for table, row, check, good in pool.map(drain, tables or sorted(found)):
            rows.append(row)
            checks.append(check)
            if not good:
                failed.append(table)
    for log, parts in (("data_lineage", rows), ("data_quality", [c for c in checks if c is not None])):
        if parts:
            reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("append").parquet(log_path(root, log))
    return failed
