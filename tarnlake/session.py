"""Session settings and the shared folders the jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the jobs rely on; all are ordinary Spark SQL options.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Shuffle files go when the action that wrote them ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# A task sorts what one split or one shuffle partition holds, so both are bounded, in bytes as stored: files hold some ten times as much.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
# Shuffle partitions of table queries before adaptive execution joins small ones; beyond 200 Spark sorts rows once more to write them.
TABLE_PARTITIONS = 200


def tune(spark: SparkSession, partitions: int = 0) -> SparkSession:
    """Set what the jobs rely on. Shuffles start with ``partitions`` if the session has fewer; smaller bounds of the session stay."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in MOST_BYTES.items():
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    first = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def local_session(
    cores: int | str = 8, partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarnlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tarnlake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Cut lineage through reliable storage, so a lost executor costs nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
