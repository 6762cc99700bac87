"""Shared by the text operators: tables, word splitting, stored intermediate results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.session import fresh_folder

# White space that parts words: space and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """All words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Steps stored inside are deleted at the end: what was made from them must be written or consumed by then."""
    _scopes.append([])
    try:
        yield
    finally:
        freed(*_scopes.pop())


def stored(df: DataFrame, label: str, compression: str = "snappy", keep: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: short lineage that survives lost executors. ``keep``: beyond the end of a ``scratch`` too."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if _scopes and not keep:
        _scopes[-1].append(out)
    return out


def freed(*steps: DataFrame) -> None:
    """Delete stored steps that nothing reads any more: all that was made from them is stored itself."""
    for df in steps:
        hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only if the stored table is counted at no more than ``rows`` rows.

    Beyond that Spark joins by shuffle; the result is the same either way.
    """
    return F.broadcast(df) if df.count() <= rows else df


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> None:
    """Bound what one Arrow batch of long texts holds in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
