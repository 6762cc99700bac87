"""Tables partitioned by a hash bucket of their key, so that an upsert reads and rewrites what it changes.

The number of buckets is part of the partition column's name, so a table is never read with another number. Buckets are
replaced one by one when the write commits; an upsert that is run again gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.merge import ACTION, scd1_merge, unique_source
from tarnlake.session import fresh_folder

PREFIX = "_bucket_of_"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was stored at the path."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and any(s.getPath().getName().startswith(PREFIX) for s in fs.listStatus(root))


def bucket_column(df: DataFrame) -> str:
    return next(c for c in df.columns if c.startswith(PREFIX))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(bucket_column(df))


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, path: str, column: str) -> None:
    df.repartition(F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def upsert_buckets(source: DataFrame, path: str, keys: Sequence[str], compare: Sequence[str], buckets: int = 64) -> DataFrame:
    """Merge the source's rows, best those of one run, into the stored table; returns the rows of the buckets that
    were touched with what happened to each.

    Only touched buckets of the target are read, and only those with a new or changed row are written. The merged rows are
    stored before anything is replaced.
    """
    spark = source.sparkSession
    there = exists(spark, path)
    column = bucket_column(spark.read.parquet(path)) if there else f"{PREFIX}{buckets}"
    count = int(column.removeprefix(PREFIX))
    rows = source.withColumn(column, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))
    if not there:
        merged = _staged(unique_source(rows, keys).withColumn(ACTION, F.lit("insert")), "merged")
        _write(merged.drop(ACTION), path, column)
        return merged.drop(column)
    rows = _staged(rows, "incoming")
    touched = [r[0] for r in rows.select(column).distinct().collect()]  # at most the number of buckets
    target = spark.read.parquet(path).filter(F.col(column).isin(touched))
    merged = _staged(scd1_merge(target, rows, keys, compare), "merged")
    changed = [r[0] for r in merged.filter(F.col(ACTION) != "keep").select(column).distinct().collect()]
    if changed:
        _write(merged.filter(F.col(column).isin(changed)).drop(ACTION), path, column)
    return merged.drop(column)
