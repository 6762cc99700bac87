"""Reports over the lineage, quality and pipeline run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _seconds():
    return F.unix_timestamp("EndDate") - F.unix_timestamp("StartDate")


def mean_duration(lineage: DataFrame) -> DataFrame:
    return lineage.agg(F.avg(_seconds()).alias("AvgDurationSeconds"))


def failed_loads(lineage: DataFrame) -> DataFrame:
    return lineage.filter("Status = 'FAIL'").agg(F.count(F.lit(1)).alias("FailedLoads"))


def recent_runs(run_log: DataFrame, now=None, days: int = 1) -> DataFrame:
    """Pipeline runs started in the last day before ``now``."""
    end = F.current_timestamp() if now is None else now
    start = end - F.expr(f"interval {int(days)} days")
    return run_log.filter((F.col("StartTime") >= start) & (F.col("StartTime") <= end)).agg(
        F.count("ADFRunID").alias("RecentRuns")
    )


def failed_checks(quality: DataFrame) -> DataFrame:
    return (
        quality.filter("Status = 'FAIL'")
        .groupBy("TableName", "CheckType")
        .agg(F.count(F.lit(1)).alias("FailedChecks"))
    )


def failed_rows(quality: DataFrame) -> DataFrame:
    return (
        quality.filter("Status = 'FAIL'")
        .groupBy("TableName", "ColumnName", "Layer", "CheckType")
        .agg(F.sum("FailedRows").alias("FailedRows"), F.sum("TotalRows").alias("TotalRows"))
    )


def load_by_table(lineage: DataFrame) -> DataFrame:
    return lineage.groupBy("TableSaved").agg(
        F.sum("QtyRead").alias("QtyRead"), F.avg(_seconds()).alias("AvgDurationSeconds")
    )


def by_log_day(log: DataFrame, time_column: str) -> DataFrame:
    """Log rows counted per day, whatever the years of the log, with the day's calendar columns."""
    counted = log.groupBy(F.to_date(time_column).alias("FullDate")).agg(F.count(F.lit(1)).alias("LogRows"))
    return counted.select(
        "FullDate", "LogRows", F.year("FullDate").alias("CalendarYear"),
        F.month("FullDate").alias("MonthNumberOfYear"), F.dayofmonth("FullDate").alias("DayNumberOfMonth"))


def failures(lineage: DataFrame) -> DataFrame:
    return lineage.filter("Status = 'FAIL'").select(
        "ProcessName", "Layer", "TableSaved", "StartDate", "ErrorMsg"
    )
