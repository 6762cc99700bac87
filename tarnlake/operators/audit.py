"""Lineage rows and pipeline run logs, as typed rows to append."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.dedup import dedup

LINEAGE = (
    "RunID string, ProcessName string, Layer string, TableSaved string, StartDate timestamp, "
    "EndDate timestamp, QtyRead bigint, QtyWritten bigint, Status string, ErrorMsg string"
)
RUN_LOG = (
    "ADFRunID string, PipelineName string, TriggerName string, TriggerTime timestamp, "
    "StartTime timestamp, EndTime timestamp, Status string, ErrorMessage string"
)
ERROR_LENGTH = 500


def new_run_id() -> str:
    return uuid.uuid4().hex


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _message(error: object) -> str | None:
    return None if error is None else str(error).replace("'", " ")[:ERROR_LENGTH]


def lineage_row(
    spark: SparkSession,
    *,
    run_id: str,
    process: str,
    layer: str,
    table: str,
    start: datetime,
    read: int = 0,
    written: int = 0,
    status: str = "SUCCESS",
    error: object = None,
    end: datetime | None = None,
) -> DataFrame:
    row = (run_id, process, layer, table, start, end or _now(), read, written, status, _message(error))
    return spark.createDataFrame([row], LINEAGE)


def tracked_write(
    df: DataFrame,
    write: Callable[[DataFrame], object],
    *,
    run_id: str,
    process: str,
    layer: str,
    table: str,
    read: int | None = None,
) -> DataFrame:
    """Write, counting rows on the way, and return the lineage row. A failure is
    reported as a FAIL row so the next table can go on."""
    spark, start = df.sparkSession, _now()
    seen = Observation()
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        rows = int(seen.get["rows"])
        return lineage_row(
            spark, run_id=run_id, process=process, layer=layer, table=table, start=start,
            read=rows if read is None else read, written=rows,
        )
    except Exception as error:
        return lineage_row(
            spark, run_id=run_id, process=process, layer=layer, table=table, start=start,
            read=read or 0, status="FAIL", error=error,
        )


def run_started(
    spark: SparkSession, run_id: str, pipeline: str, trigger: str, trigger_time: str | None
) -> DataFrame:
    """STARTED row; an unreadable trigger time becomes the current time."""
    return (
        spark.createDataFrame(
            [(run_id, pipeline, trigger, trigger_time)],
            "ADFRunID string, PipelineName string, TriggerName string, t string",
        )
        .select(
            "ADFRunID", "PipelineName", "TriggerName",
            F.coalesce(F.expr("try_cast(t as timestamp)"), F.current_timestamp()).alias("TriggerTime"),
            F.current_timestamp().alias("StartTime"),
            F.lit(None).cast("timestamp").alias("EndTime"),
            F.lit("STARTED").alias("Status"),
            F.lit(None).cast("string").alias("ErrorMessage"),
        )
    )


def run_finished(spark: SparkSession, run_id: str, status: str, error: object = None) -> DataFrame:
    """End row of a run; joined to its start by ``run_state``."""
    return spark.createDataFrame(
        [(run_id, None, None, None, None, _now(), status, _message(error))], RUN_LOG
    )


def run_state(log: DataFrame) -> DataFrame:
    """Current state of each run from its appended start and end rows."""
    latest = dedup(
        log.select("ADFRunID", "Status", "EndTime", "ErrorMessage"),
        ["ADFRunID"],
        ["EndTime desc", "Status"],
    )
    first = log.groupBy("ADFRunID").agg(
        F.max("PipelineName").alias("PipelineName"),
        F.max("TriggerName").alias("TriggerName"),
        F.min("TriggerTime").alias("TriggerTime"),
        F.min("StartTime").alias("StartTime"),
    )
    return first.join(latest, "ADFRunID").select(
        "ADFRunID", "PipelineName", "TriggerName", "TriggerTime", "StartTime", "EndTime",
        "Status", "ErrorMessage",
    )
