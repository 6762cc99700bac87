"""Surrogate keys from reserved blocks, for loads that may run side by side.

Blocks are reserved in stretches of 1, 64, 4096, ... neighbours, by creating a file of the stretch's length and number, which only
one run can do; each length has block numbers of its own. So a run creates a few files, however many blocks it needs. It numbers its new
rows by partition counts and fills its blocks. New rows are neither sorted, nor is the target's highest key read, and a run that fails
wastes its blocks at most. Keys say nothing of the order of natural keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.session import checkpointed

BLOCK = 1 << 20
# Lengths of stretches are 2 to SHIFT times 0, 1, ...; blocks of the n-th length have numbers from n times 2 to FIRST on.
SHIFT, LENGTHS, FIRST = 6, 5, 33


def _created(spark: SparkSession, fs, file) -> bool:
    """Create a file that must be new; False if it is there. Atomic in a shared file system, and by the system's own call locally."""
    if fs.getUri().getScheme() == "file":
        return spark.sparkContext._jvm.java.io.File(fs.makeQualified(file).toUri().getPath()).createNewFile()
    try:
        fs.create(file, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _file(nth: int, number: int) -> str:
    return f"{number:012d}" if nth == 0 else f"{number:012d}x{1 << SHIFT * nth}"


def reserve_stretches(spark: SparkSession, path: str, blocks: int) -> list[tuple[int, int]]:
    """Stretches that no other run has or will get, longest first, of ``blocks`` blocks together: the n of their length, first block."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    there = [s.getPath().getName() for s in fs.listStatus(folder)]
    mine = []
    for nth in reversed(range(LENGTHS)):
        wanted = blocks >> SHIFT * nth
        blocks -= wanted << SHIFT * nth
        numbers = [int(n.partition("x")[0]) for n in there if n.partition("x")[0].isdigit() and n == _file(nth, int(n.partition("x")[0]))]
        number = max(numbers, default=-1) + 1
        while wanted:
            if _created(spark, fs, hadoop.Path(folder, _file(nth, number))):
                mine.append((nth, (nth << FIRST) + (number << SHIFT * nth)))
                wanted -= 1
            number += 1
    return mine


def reserve(spark: SparkSession, path: str, blocks: int) -> list[int]:
    """Numbers of blocks that no other run has or will get."""
    return [b for nth, first in reserve_stretches(spark, path, blocks) for b in range(first, first + (1 << SHIFT * nth))]


def key_rows(new: DataFrame, sk: str, path: str, block: int = BLOCK) -> DataFrame:
    """Add the surrogate key ``sk``, from 1 on, to every row."""
    spark = new.sparkSession
    # Stored, so that the rows counted are the rows numbered.
    placed = checkpointed(new.withColumn("_pos", F.monotonically_increasing_id()))
    part, local = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = checkpointed(placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_offset"))
    # The i-th block wanted lies in a stretch told by its length and its number among the stretches of that length.
    stretches, wanted, starts = [], 0, {}
    for nth, first in reserve_stretches(spark, path, -(-total // block)):
        start = starts.setdefault(nth, wanted)
        stretches.append((nth, (wanted - start) >> SHIFT * nth, wanted, first))
        wanted += 1 << SHIFT * nth
    mine = spark.createDataFrame(stretches, "_nth int, _s long, _start long, _first long")
    nth, s = F.lit(-1), F.lit(-1).cast("long")
    for n, start in starts.items():
        nth = F.when(F.col("_i") >= start, n).otherwise(nth)
        s = F.when(F.col("_i") >= start, F.shiftright(F.col("_i") - start, SHIFT * n)).otherwise(s)
    # One row for each partition, and one for each stretch.
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_r", F.col("_offset") + local)
    return ranked.withColumn("_i", F.floor(F.col("_r") / block)).withColumns({"_nth": nth, "_s": s}).join(F.broadcast(mine), ["_nth", "_s"]).withColumn(
        sk, (F.col("_first") + F.col("_i") - F.col("_start")) * block + F.col("_r") % block + 1).select(*new.columns, sk)


def assign_from_ledger(new: DataFrame, target: DataFrame | None, sk: str, natural: Sequence[str], path: str, block: int = BLOCK) -> DataFrame:
    """Keys for the rows of ``new`` whose natural key the target lacks; keys given out before are never changed."""
    if target is not None:
        new = new.join(target.select(*natural), list(natural), "left_anti")
    return key_rows(new, sk, path, block)
