"""Drain-and-stop file streams into raw tables.

Map-only micro-batches: no shuffle, no state. The checkpoint remembers which files
were taken, so a rerun appends only new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


RUN = "IngestRunID"  # raw tables are partitioned by it
REPORTS, KEPT = "spark.sql.streaming.numRecentProgressUpdates", 10_000
POLL = 0.2  # seconds between two looks at a stream's progress


@dataclass(frozen=True)
class IngestStats:
    read: int
    written: int
    batches: int
    run_id: str
    # Whether every batch was reported; if not, written is counted and read is a lower bound.
    reported: bool = True


def file_date(pattern: str, fmt: str) -> Column:
    """Date in the file name, e.g. ``Currency_(\\d{2}-\\d{2}-\\d{4})``."""
    text = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return F.to_date(F.nullif(text, F.lit("")), fmt)


def with_ingestion(df: DataFrame, run_id: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ingestion time, source file, run id and any file-derived columns."""
    return df.select(
        "*",
        *[c.alias(n) for n, c in (extra or {}).items()],
        F.current_timestamp().alias("IngestionDate"),
        F.col("_metadata.file_path").alias("FileSource"),
        F.lit(run_id).alias("IngestRunID"),
    )


def _drain(stream: DataFrame, checkpoint: str, out: str, run_id: str) -> IngestStats:
    spark = stream.sparkSession
    before = _committed(spark, checkpoint)
    held = spark.conf.get(REPORTS)
    # A query keeps its newest reports only: enough of them, and they are added up while it runs.
    spark.conf.set(REPORTS, str(max(int(held), KEPT)))
    query = (
        stream.observe("ingest", F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .partitionBy(*([RUN] if RUN in stream.columns else []))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    spark.conf.set(REPORTS, held)
    seen: dict[int, tuple[int, int]] = {}
    done = False
    while not done:
        done = query.awaitTermination(POLL)
        for p in query.recentProgress:
            # File sinks report no output rows; the observation counts what went through.
            seen[p["batchId"]] = (p["numInputRows"], int(p["observedMetrics"]["ingest"]["rows"]) if p["numInputRows"] else 0)
    read, written = (sum(v[k] for v in seen.values()) for k in (0, 1))
    batches = _committed(spark, checkpoint) - before
    if not batches <= set(seen):
        # Which batches ran is known from the checkpoint. A report is missing: count what this run has stored.
        if RUN not in stream.columns:
            raise RuntimeError(f"no report of batches {sorted(batches - set(seen))}, and no {RUN} to count their rows by")
        written = this_run(spark.read.parquet(out), run_id).count()
        read = max(read, written)
    return IngestStats(read, written, sum(1 for v in seen.values() if v[0]), run_id, batches <= set(seen))


def _committed(spark: SparkSession, checkpoint: str) -> set[int]:
    """Batches that a stream has finished, by the names in its checkpoint."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return set()
    return {int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit()}


def ingest(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str,
    checkpoint: str,
    out: str,
    run_id: str,
    glob: str | None = None,
    options: Mapping[str, object] | None = None,
    extra: Mapping[str, Column] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> IngestStats:
    """Append the files of ``path`` not seen before to ``out`` and stop.

    ``options`` carries the reader's own settings: ``multiLine`` for JSON documents
    over several lines, ``maxFilesPerTrigger`` to bound a batch of a large backlog.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    stream = with_ingestion(reader.load(path), run_id, extra)
    return _drain(transform(stream) if transform else stream, checkpoint, out, run_id)


def positional_schema(columns: int) -> str:
    """Text columns ``_c0 .. _cN`` of a file without a header."""
    return ", ".join(f"_c{i} string" for i in range(columns))


def ingest_csv(
    spark: SparkSession,
    path: str,
    files: Mapping[str, tuple[str, int]],
    root: str,
    run_id: str,
    separator: str = ",",
) -> dict[str, IngestStats]:
    """Headerless CSV: each table has its own file glob, column count, target and
    checkpoint."""
    return {
        table: ingest(
            spark, path, "csv", positional_schema(columns), f"{root}/_checkpoints/{table}",
            f"{root}/{table}", run_id, glob=glob, options={"header": False, "sep": separator},
        )
        for table, (glob, columns) in files.items()
    }


def stream_table(
    spark: SparkSession,
    source: str,
    schema: str,
    checkpoint: str,
    out: str,
    run_id: str,
    transform: Callable[[DataFrame], DataFrame],
) -> IngestStats:
    """Table to table: only rows appended since the last run pass the transform."""
    stream = spark.readStream.schema(schema).parquet(source)
    return _drain(transform(stream), checkpoint, out, run_id)


def this_run(table: DataFrame, run_id: str) -> DataFrame:
    """Rows one run brought in; other runs' files are not read."""
    return table.filter(F.col("IngestRunID") == run_id)
