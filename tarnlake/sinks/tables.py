"""Writing tables: versioned overwrite, append, key checks, comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.keys import assert_key

MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose write finished, by the job's success marker."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def current_path(spark: SparkSession, path: str) -> str | None:
    done = _versions(spark, path)
    return f"{path.rstrip('/')}/v={done[-1]:08d}" if done else None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    here = current_path(spark, path)
    if here is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(here)


def _publish(spark: SparkSession, version: str) -> None:
    """Set the success marker that makes a written version the current one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(version, "_SUCCESS")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def remove_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions, and return their numbers. Readers of a version must be done with it."""
    if keep < 1:
        raise ValueError("the current version stays")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = _versions(spark, path)[:-keep]
    for number in gone:
        old = hadoop.Path(f"{path.rstrip('/')}/v={number:08d}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return gone


def overwrite(df: DataFrame, path: str, sort_by: Sequence[str] = (), keys: Sequence[str] = ()) -> int:
    """Write the next version of a table, its columns included, and return its rows.

    With ``keys`` the written files are checked first: a version whose key is broken is never published.

    Readers keep the old version until the new one has its success marker, so a job
    may read the table it replaces. ``sort_by`` clusters rows inside files for
    min/max pruning.
    """
    spark = df.sparkSession
    done = _versions(spark, path)
    target = f"{path.rstrip('/')}/v={(done[-1] + 1 if done else 1):08d}"
    seen = Observation()
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(MARK, str(not keys).lower())
    writer.parquet(target)
    if keys:
        assert_key(spark.read.schema(df.schema).parquet(target), keys)
        _publish(spark, target)
    return int(seen.get["rows"])


def append(df: DataFrame, path: str) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(seen.get["rows"])


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Append only rows whose key the table lacks, one of each key; running twice adds nothing."""
    spark = df.sparkSession
    df = df.dropDuplicates(list(keys))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        df = df.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    return append(df, path)


def replace_feature_table(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Replace a feature table from a query; its declared key is checked on what was
    written, before readers see it."""
    return overwrite(df, path, keys=keys)


def overwrite_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Catalog table bucketed and sorted on ``keys``; joins of tables bucketed alike
    need no shuffle (order lines with orders on the order key)."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; parquet tables saved to the catalog keep them."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )


def comment_table(spark: SparkSession, table: str, comments: Mapping[str, str]) -> None:
    """Set comments on the columns of an existing catalog table."""
    for column, text in comments.items():
        quoted = text.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT '{quoted}'")
