"""Surrogate keys, unknown members and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import checkpointed

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def number_rows(df: DataFrame, order: Sequence[str], out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the given order, without a one-task window.

    Rows are range-partitioned and sorted inside partitions; each row then needs only
    its partition's offset, and there are as many offsets as shuffle partitions. The
    ordered rows are checkpointed first, so both uses see the same partitions.
    """
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    part = F.shiftright("_pos", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    local = F.col("_pos").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + local + F.lit(start)).cast("long"))
        .drop("_part", "_pos", "_offset")
    )


def highest_key(target: DataFrame, sk: str) -> int:
    """Largest surrogate key in use, 0 when none (the unknown member is negative)."""
    top = target.agg(F.max(sk)).first()[0]
    return max(int(top or 0), 0)


def assign_keys(
    new: DataFrame, target: DataFrame | None, sk: str, natural: Sequence[str]
) -> DataFrame:
    """Give the rows of ``new`` whose natural key the target lacks the next keys, in
    natural-key order. Keys already given out are never changed."""
    if target is None:
        return number_rows(new, natural, sk)
    fresh = new.join(target.select(*natural), list(natural), "left_anti")
    return number_rows(fresh, natural, sk, highest_key(target, sk) + 1)


def with_unknown(df: DataFrame, sk: str, values: Mapping[str, object]) -> DataFrame:
    """Add the -1 member once."""
    spark = df.sparkSession
    fields = {**dict.fromkeys(df.columns), **values, sk: -1}
    row = spark.range(1).select(
        *[F.lit(fields[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row.join(df.filter(F.col(sk) == -1).select(sk), sk, "left_anti"))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, rows with a null key part, keys met more than once."""
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_rows"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_keys"),
    )


def assert_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` if its primary key holds, else raise."""
    r = key_report(df, keys).first()
    if r["null_rows"] or r["duplicate_keys"]:
        raise ValueError(
            f"key {list(keys)} broken: {r['null_rows']} null rows, "
            f"{r['duplicate_keys']} duplicate keys"
        )
    return df
