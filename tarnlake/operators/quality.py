"""Data-quality checks: one aggregate pass per check type, however many columns, and one for both types together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.scalars import blank

RECORD = (
    "RunID string, ProcessName string, TableName string, ColumnName string, Layer string, "
    "CheckType string, TotalRows bigint, FailedRows bigint, Status string, CheckDate timestamp"
)

SUCCESS, FAIL = "SUCCESS", "FAIL"


def _as_rows(one_row: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn the single aggregate row into one row per check (label, type, column of the failed rows)."""
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("ColumnName"), F.lit(check).alias("CheckType"), F.col(failed).cast("long").alias("FailedRows"))
            for label, check, failed in checks
        ]
    )
    return one_row.filter("total > 0").select(
        F.inline(entries), F.col("total").alias("TotalRows")
    ).select("ColumnName", "CheckType", "TotalRows", "FailedRows")


def null_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that are null or blank, per column."""
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(blank(c), 1)).alias(f"f{i}") for i, c in enumerate(columns)],
    )
    return _as_rows(one, [(c, "NULL", f"f{i}") for i, c in enumerate(columns)])


def duplicate_checks(df: DataFrame, key_sets: Sequence[str | Sequence[str]]) -> DataFrame:
    """Rows beyond the first per key; null counts as one value. A key may have several
    columns. The table is read once; of several keys each travels as two hashes (128 bits), however many columns it has and
    however wide they are, and equal keys are collapsed inside tasks before they are shuffled."""
    if not key_sets:
        return df.sparkSession.createDataFrame([], "ColumnName string, CheckType string, TotalRows bigint, FailedRows bigint")
    return both_checks(df, (), key_sets)


def both_checks(df: DataFrame, null_cols: Sequence[str], key_sets: Sequence[str | Sequence[str]]) -> DataFrame:
    """Rows of ``null_checks`` and ``duplicate_checks`` from one pass: blank values are counted along with the hashed keys."""
    sets = [[k] if isinstance(k, str) else list(k) for k in key_sets]

    def key(i: int, cols: list[str]) -> Column:
        # A hash passes over nulls, so it is told where they are.
        parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
        return F.struct(F.lit(i).alias("i"), F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *reversed(parts)).alias("b"))

    blanks = [f"b{j}" for j in range(len(null_cols))]
    flags = [F.when(blank(c), 1).otherwise(0).alias(b) for b, c in zip(blanks, null_cols)]
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(b).alias(b) for b in blanks]]
    if len(sets) == 1:
        # One key: rows that are partitioned by it already, as cleaned ones are, are not shuffled again.
        parts = [f"k{j}" for j in range(len(sets[0]))]
        met = df.select(*[F.col(c).alias(k) for k, c in zip(parts, sets[0])], *flags).groupBy(*parts).agg(*sums).withColumn("i", F.lit(0))
    else:
        # Plain columns: the fast hash map of Spark's sums takes no structs.
        met = df.select(F.inline(F.array(*[key(i, c) for i, c in enumerate(sets)])), *flags).groupBy("i", "a", "b").agg(*sums)
    found = met.groupBy("i").agg(F.sum("n").alias("total"), (F.sum("n") - F.count(F.lit(1))).alias("failed"), *[F.sum(b).alias(b) for b in blanks])
    one = found.agg(
        F.coalesce(F.max("total"), F.lit(0)).alias("total"),
        *[F.coalesce(F.max(F.when(F.col("i") == i, F.col("failed"))), F.lit(0)).alias(f"f{i}") for i in range(len(sets))],
        *[F.coalesce(F.max(b), F.lit(0)).alias(b) for b in blanks])
    told = [(c, "NULL", b) for c, b in zip(null_cols, blanks)] + [(", ".join(c), "DUPLICATE", f"f{i}") for i, c in enumerate(sets)]
    return _as_rows(one, told)


def quality(
    df: DataFrame,
    null_cols: Sequence[str],
    key_sets: Sequence[str | Sequence[str]],
    *,
    run_id: str,
    process: str,
    layer: str,
    table: str,
) -> DataFrame:
    """Quality log rows for one table; an empty input gives none."""
    if not null_cols and not key_sets:
        return df.sparkSession.createDataFrame([], RECORD)
    checks = both_checks(df, null_cols, key_sets) if key_sets else null_checks(df, null_cols)
    return checks.select(
        F.lit(run_id).alias("RunID"),
        F.lit(process).alias("ProcessName"),
        F.lit(table).alias("TableName"),
        "ColumnName",
        F.lit(layer).alias("Layer"),
        "CheckType",
        "TotalRows",
        "FailedRows",
        F.when(F.col("FailedRows") == 0, SUCCESS).otherwise(FAIL).alias("Status"),
        F.current_timestamp().alias("CheckDate"),
    )
