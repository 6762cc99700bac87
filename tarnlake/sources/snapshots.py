"""Landing folders of table snapshots: listing, newest pick, extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Path and time of every file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "modificationTime")
    )


def snapshot_tables(files: DataFrame) -> DataFrame:
    """Table name ``<schema>_<table>`` for ``.../<schema>/<table>/<file>`` paths. A
    snapshot written by several tasks is a folder of part files; its own name counts."""
    parts = F.split(F.regexp_replace("path", r"\.parquet/part-[^/]*$", ".parquet"), "/")
    return files.select(
        "path", F.lower(F.concat_ws("_", F.element_at(parts, -3), F.element_at(parts, -2))).alias("table_name"),
        F.regexp_replace("path", r"\.parquet/part-[^/]*$", ".parquet").alias("snapshot"),
        "modificationTime",
    )


def unfinished(spark: SparkSession, found: DataFrame) -> list[str]:
    """Snapshot folders whose writer has not set its success marker; only folder names reach the driver."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for r in found.filter("path <> snapshot").select("snapshot").distinct().toLocalIterator():
        mark = hadoop.Path(r["snapshot"], "_SUCCESS")
        if not mark.getFileSystem(conf).exists(mark):
            out.append(r["snapshot"])
    return out


def latest_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Newest finished snapshot per table by modification time (the name breaks ties)."""
    found = snapshot_tables(list_files(spark, root))
    open_ones = unfinished(spark, found)
    if open_ones:
        found = found.join(spark.createDataFrame([(s,) for s in open_ones], "snapshot string"), "snapshot", "left_anti")
    newest = F.max_by("snapshot", F.struct("modificationTime", "snapshot"))
    return found.groupBy("table_name").agg(newest.alias("snapshot"))


def read_latest(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Newest snapshot of every table; the driver sees one path per table."""
    return {
        r["table_name"]: spark.read.parquet(r["snapshot"])
        for r in latest_snapshots(spark, root).collect()
    }


def append_evolving(current: DataFrame, addition: DataFrame) -> DataFrame:
    """Append with new columns allowed on either side."""
    return current.unionByName(addition, allowMissingColumns=True)


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of differing columns as one table."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def extract_schema(
    tables: Mapping[str, DataFrame],
    schema: str,
    root: str,
    stamp: str,
    overrides: Mapping[str, Sequence[str]] | None = None,
    exclude: Sequence[str] = (),
) -> list[str]:
    """Copy each table to ``<root>/<schema>/<table>/<table>_<stamp>.parquet``.

    ``overrides`` gives a table its own select list (vendor types to text);
    ``exclude`` leaves tables out. The source may be any reader's DataFrame.
    """
    written = []
    for name, df in tables.items():
        if name in exclude:
            continue
        picked = df.selectExpr(*overrides[name]) if overrides and name in overrides else df
        path = f"{root.rstrip('/')}/{schema}/{name}/{name}_{stamp}.parquet"
        picked.write.mode("overwrite").option("compression", "snappy").parquet(path)
        written.append(path)
    return written


def jdbc_tables(
    spark: SparkSession, url: str, catalog: DataFrame, key: Mapping[str, tuple[str, int, int, int]]
) -> dict[str, DataFrame]:
    """Catalog rows (schema, table) as JDBC readers. ``key`` names a numeric split
    column with its bounds and partition count per table, so large tables are read by
    many tasks."""
    out = {}
    for r in catalog.select("schema", "table").collect():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"{r[0]}.{r[1]}")
        if r[1] in key:
            column, low, high, parts = key[r[1]]
            reader = (
                reader.option("partitionColumn", column)
                .option("lowerBound", low)
                .option("upperBound", high)
                .option("numPartitions", parts)
            )
        out[r[1]] = reader.load()
    return out


def catalog_without(catalog: DataFrame, excluded: DataFrame) -> DataFrame:
    """Catalog rows left after an exclusion list of (schema, table)."""
    return catalog.join(excluded, ["schema", "table"], "left_anti")
