"""A stored log of what columns each snapshot of a raw table had.

A new snapshot's footer is opened once, when it is entered; from then on a table's columns come from the log. Columns may be
new, and types may grow where every old value is still the same value (whole numbers, floats, decimals with more digits).
Any other change is refused with the column's name, and the log stays as it was. One folder for each table, so that tables can be
entered side by side.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.sinks import tables as sink

ENTRY = "snapshot string, columns string, run_id string"
# Whole and floating numbers, each wider than those before it.
CHAINS = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


class SchemaChange(ValueError):
    """A snapshot's column cannot join the table's."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both as they are; None if there is none."""
    if a == b:
        return a
    for chain in CHAINS:
        if isinstance(a, chain) and isinstance(b, chain):
            return max(a, b, key=lambda t: chain.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def joined(known: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """The columns of both, names in any case; raises ``SchemaChange`` for a type that cannot grow."""
    fields = {f.name.lower(): f for f in known}
    for f in new:
        old = fields.get(f.name.lower())
        kind = f.dataType if old is None else wider(old.dataType, f.dataType)
        if kind is None:
            raise SchemaChange(f"{where}column {f.name} turns from {old.dataType.simpleString()} to {f.dataType.simpleString()}")
        fields[f.name.lower()] = T.StructField(old.name if old else f.name, kind, True)
    return T.StructType(list(fields.values()))


def _log(spark: SparkSession, path: str, table: str) -> DataFrame:
    folder = f"{path.rstrip('/')}/{table}"
    if sink.current_path(spark, folder) is None:
        return spark.createDataFrame([], ENTRY)
    return sink.read_current(spark, folder)


def columns_of(spark: SparkSession, path: str, table: str) -> T.StructType:
    """A table's columns over all its snapshots, from the log alone. Snapshots share few sets of columns."""
    sets = _log(spark, path, table).groupBy("columns").agg(F.min("snapshot").alias("first")).orderBy("first").collect()
    return reduce(joined, (T.StructType.fromJson(json.loads(r["columns"])) for r in sets), T.StructType([]))


def footer(spark: SparkSession, snapshot: str) -> T.StructType:
    """Columns of one snapshot, from the footer of one of its files."""
    return spark.read.option("mergeSchema", False).parquet(snapshot).schema


def enter(spark: SparkSession, path: str, table: str, snapshots: Sequence[str], run_id: str) -> T.StructType:
    """Enter the snapshots the log lacks and return the table's columns. Only new snapshots are opened."""
    log = _log(spark, path, table)
    given = spark.createDataFrame([(s, k) for k, s in enumerate(snapshots)], "snapshot string, k int")
    new = [r["snapshot"] for r in given.join(log, "snapshot", "left_anti").orderBy("k").collect()]
    known, rows = columns_of(spark, path, table), []
    for snapshot in new:
        columns = footer(spark, snapshot)
        known = joined(known, columns, f"{table}, {snapshot.rsplit('/', 1)[-1]}: ")
        rows.append((snapshot, columns.json(), run_id))
    if rows:
        sink.overwrite(log.unionByName(spark.createDataFrame(rows, ENTRY)).coalesce(1), f"{path.rstrip('/')}/{table}")
    return known
