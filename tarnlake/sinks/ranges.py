"""Tables in files of key ranges with a stored list of files, so that an upsert adds files and rewrites none.

Rows are range-partitioned by key. The list holds, for each file, the lowest and highest key, its rows, the blocks of keys it
holds, and whether its rows are new keys (base) or newer values of stored ones (overrides). A load reads only base files that may hold
one of its keys, by range and block, and adds one set of files with new keys and one with overrides. Readers take the newest override of a
key before its base row; without overrides they scan base files and join nothing. An override may also say that a row is gone.
``compact_ranges`` folds the overrides into the base files they touch. The list is written last and as a whole version, so readers see a load entirely or not at all, and a
load that is run again after a failure gives the same table. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators.merge import ACTION, differs_from, unique_source
from tarnlake.session import fresh_folder
from tarnlake.sinks import tables as sink

# Keys of a block: 2 to this power; blocks a file may list before it counts as holding any key of its range.
BLOCK_BITS, MOST_BLOCKS = 12, 4096
LOAD, GONE = "_load", "_gone"


@dataclass
class Upsert:
    """What a load did: rows it brought, the inserted and updated ones with their ``merge_action``, and what the updated
    and removed ones were before."""

    read: int
    changed: DataFrame
    before: DataFrame


def exists(spark: SparkSession, path: str) -> bool:
    return sink.current_path(spark, _list_path(path)) is not None


def _list_path(path: str) -> str:
    return f"{path.rstrip('/')}/list"


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """file, overrides, load, low, high, rows, blocks of every file of the table."""
    return sink.read_current(spark, _list_path(path)).filter("file IS NOT NULL").drop("columns")


def _columns(spark: SparkSession, path: str) -> T.StructType:
    row = sink.read_current(spark, _list_path(path)).filter("file IS NULL").first()
    return T.StructType.fromJson(json.loads(row["columns"]))


def _block(key: str, kind: T.DataType) -> Column:
    """The block a key is in: neighbours for integers, a share of all keys otherwise."""
    if isinstance(kind, T.IntegralType):
        return F.shiftright(F.col(key).cast("long"), BLOCK_BITS)
    return F.shiftright(F.xxhash64(key), 64 - 20)


def _add_files(rows: DataFrame, path: str, keys: Sequence[str], overrides: bool, load: int, check: bool = False) -> DataFrame:
    """Write rows as files of key ranges and return their entries for the list; ``check``: fail at a second row for a key."""
    spark, folder = rows.sparkSession, f"load-{load:08d}-{'overrides' if overrides else 'base'}"
    target, kind = f"{path.rstrip('/')}/files/{folder}", rows.schema[keys[0]].dataType
    ranged = rows.repartitionByRange(*keys)
    ranged = unique_source(ranged, keys) if check else ranged.sortWithinPartitions(*keys)
    if GONE not in rows.columns:
        ranged = ranged.withColumn(GONE, F.lit(False))
    ranged.withColumn(LOAD, F.lit(load)).write.mode("overwrite").parquet(target)
    block = _block(keys[0], kind)
    written = spark.read.schema(rows.schema).parquet(target).select(F.col("_metadata.file_name").alias("name"), keys[0], block.alias("block"))
    # Rows are counted per block first; a file lists its blocks only if they are few.
    found = written.groupBy("name", "block").agg(F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high"), F.count("*").alias("rows"))
    stats = found.withColumn("nth", F.row_number().over(Window.partitionBy("name").orderBy("block"))).groupBy("name").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"), F.count("*").alias("n_blocks"),
        F.collect_list(F.when(F.col("nth") <= MOST_BLOCKS, F.col("block"))).alias("blocks"))
    return stats.select(
        F.concat(F.lit(f"{folder}/"), "name").alias("file"), F.lit(overrides).alias("overrides"), F.lit(load).alias("load"), "low", "high", "rows",
        F.when(F.col("n_blocks") <= MOST_BLOCKS, F.col("blocks")).alias("blocks"))


def _publish(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[DataFrame]) -> None:
    key = parts[0].select("low").schema[0].dataType.simpleString()
    head = spark.sql(
        f"SELECT CAST(NULL AS STRING) AS file, false AS overrides, 0 AS load, CAST(NULL AS {key}) AS low, CAST(NULL AS {key}) AS high, "
        "0L AS rows, CAST(NULL AS ARRAY<BIGINT>) AS blocks").withColumn("columns", F.lit(schema.json()))
    out = head
    for part in parts:
        out = out.unionByName(part.withColumn("columns", F.lit(None).cast("string")))
    sink.overwrite(out.coalesce(1), _list_path(path))


def _open(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField(LOAD, T.IntegerType())])
    if not files:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(*[f"{path.rstrip('/')}/files/{f}" for f in files])


def _newest(overrides: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in overrides.columns if c not in keys]
    last = overrides.groupBy(*keys).agg(F.max_by(F.struct(*rest), LOAD).alias("_row"))
    return last.select(*keys, "_row.*").select(*overrides.columns)


def _merged(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, entries: Sequence) -> DataFrame:
    """Rows of the given files, the newest of each key."""
    base = _open(spark, path, schema, [e["file"] for e in entries if not e["overrides"]])
    over = [e["file"] for e in entries if e["overrides"]]
    if over:
        newest = _newest(_open(spark, path, schema, over), keys)
        base = base.join(newest.select(*keys), list(keys), "left_anti").select(*base.columns).unionByName(newest.filter(f"NOT {GONE}"))
    return base.drop(LOAD, GONE)


def read_ranges(spark: SparkSession, path: str, keys: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """The table as it stands, or its rows of the ``wanted`` values of the first key: then only files that may hold one are opened.
    The names of files are collected, nothing else."""
    entries = file_list(spark, path)
    if wanted is not None:
        entries = touched_files(entries, wanted, keys[0])
    rows = _merged(spark, path, keys, _columns(spark, path), entries.select("file", "overrides").collect())
    return rows if wanted is None else rows.join(wanted.select(keys[0]).distinct(), keys[0], "left_semi").select(*rows.columns)


def touched_files(listed: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The files of the list that may hold one of the incoming keys, by range and block."""
    low, high = incoming.agg(F.min(key), F.max(key)).first()
    if low is None:
        return listed.limit(0)
    near = listed.filter((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    asked = incoming.select(_block(key, incoming.schema[key].dataType).alias("block")).distinct()
    hit = near.filter("blocks IS NOT NULL").select("file", F.explode("blocks").alias("block")).join(asked, "block", "left_semi").select("file").distinct()
    return near.join(hit, "file", "left_semi").unionByName(near.filter("blocks IS NULL"))


def upsert_ranges(source: DataFrame, path: str, keys: Sequence[str], compare: Sequence[str], staged: bool = False) -> Upsert:
    """Merge the source's rows into the table: new keys are added, matched rows take the source's values when a compared
    column differs (null-safely). A second source row for a key fails the load before anything is listed.

    The source is stored first, as it is read several times; ``staged``: it is made of stored files already."""
    spark, keys = source.sparkSession, list(keys)
    if staged:
        return _upsert(source, source.count(), path, keys, compare)
    folder = fresh_folder(spark, "incoming")
    done = _upsert(*_staged(source, folder), path, keys, compare)
    _remove(spark, folder)
    return done


def _upsert(incoming: DataFrame, read: int, path: str, keys: list[str], compare: Sequence[str]) -> Upsert:
    spark = incoming.sparkSession
    if not exists(spark, path):
        return _first_load(incoming, path, keys, read)
    target = _target(incoming, path, keys)
    joined = unique_source(incoming, keys).alias("s").join(
        target.withColumn("_t", F.lit(1)).alias("t"), [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys], "left")
    action = F.when(F.col("t._t").isNull(), "insert").when(differs_from(compare), "update").otherwise("keep")
    return _apply(joined, action, incoming, path, keys, read)


def replace_within(source: DataFrame, path: str, keys: Sequence[str], scope: DataFrame) -> Upsert:
    """The source becomes all there is for the values of the first keys in ``scope`` (columns: some of the first keys);
    stored rows of the scope that the source lacks are removed. The source's rows must be within the scope."""
    spark, keys, folder = source.sparkSession, list(keys), fresh_folder(source.sparkSession, "incoming")
    done = _replace(*_staged(source, folder), path, keys, scope)
    _remove(spark, folder)
    return done


def _replace(incoming: DataFrame, read: int, path: str, keys: list[str], scope: DataFrame) -> Upsert:
    if not exists(incoming.sparkSession, path):
        return _first_load(incoming, path, keys, read)
    scope = scope.distinct()
    target = _target(scope, path, keys).join(scope, scope.columns, "left_semi").select(*incoming.columns)
    joined = unique_source(incoming, keys).withColumn("_s", F.lit(1)).alias("s").join(
        target.withColumn("_t", F.lit(1)).alias("t"), [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys], "full")
    compare = [c for c in incoming.columns if c not in keys]
    action = F.when(F.col("t._t").isNull(), "insert").when(F.col("s._s").isNull(), "remove").when(differs_from(compare), "update").otherwise("keep")
    return _apply(joined, action, incoming, path, keys, read)


def staged(source: DataFrame) -> DataFrame:
    """The rows, stored as columns and compressed, which checkpoints are not."""
    return _staged(source, fresh_folder(source.sparkSession, "incoming"))[0]


def _staged(source: DataFrame, folder: str) -> tuple[DataFrame, int]:
    seen = Observation()
    source.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    return source.sparkSession.read.schema(source.schema).parquet(folder), int(seen.get["rows"])


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a load's own copy of its rows; what the load returns is read from other files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = hadoop.Path(folder)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def _first_load(incoming: DataFrame, path: str, keys: Sequence[str], read: int) -> Upsert:
    spark, schema = incoming.sparkSession, incoming.schema
    # The check rides on the range partitioning and sort of the write.
    _publish(spark, path, schema, [_add_files(incoming, path, keys, False, 1, check=True)])
    rows = _open(spark, path, schema, [r["file"] for r in file_list(spark, path).select("file").collect()]).drop(LOAD, GONE)
    return Upsert(read, rows.withColumn(ACTION, F.lit("insert")), rows.limit(0))


def _target(wanted: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows of all files that may hold a wanted first key."""
    spark = wanted.sparkSession
    schema = _columns(spark, path)
    if not set(wanted.columns) <= set(schema.names) or keys[0] not in wanted.columns:
        raise ValueError(f"columns differ from the stored table's: {sorted(set(wanted.columns) ^ set(schema.names))}")
    files = touched_files(file_list(spark, path), wanted, keys[0]).select("file", "overrides").collect()
    return _merged(spark, path, keys, schema, files)


def _apply(joined: DataFrame, action: Column, incoming: DataFrame, path: str, keys: Sequence[str], read: int) -> Upsert:
    """Store what changes (s: new rows, t: stored ones), add its files and list them."""
    spark, columns = incoming.sparkSession, incoming.columns
    schema, folder = _columns(spark, path), fresh_folder(spark, "changed")
    if set(schema.names) != set(columns):
        raise ValueError(f"columns differ from the stored table's: {sorted(set(columns) ^ set(schema.names))}")
    tagged = joined.withColumn(ACTION, action).filter(F.col(ACTION) != "keep").select(
        *[F.coalesce(f"s.{c}", f"t.{c}").alias(c) if c in keys else F.col(f"s.{c}").alias(c) for c in columns],
        F.when(F.col("t._t").isNotNull(), F.struct(*[F.col(f"t.{c}").alias(c) for c in columns])).alias("_before"), ACTION)
    tagged.write.partitionBy(ACTION).parquet(folder)
    done = spark.read.schema(tagged.schema).parquet(folder)
    kinds, listed = {r[0] for r in done.select(ACTION).distinct().collect()}, file_list(spark, path)
    load = listed.agg(F.coalesce(F.max("load"), F.lit(0))).first()[0] + 1
    added, back = [], None
    if "insert" in kinds:
        new = done.filter(F.col(ACTION) == "insert").select(*columns)
        near = touched_files(listed.filter("overrides"), new, keys[0]).select("file").collect()
        if near:
            # A key that was removed before has an override that must be overridden, not a new base row.
            again = _open(spark, path, schema, [r["file"] for r in near]).filter(GONE).select(*keys)
            back = new.join(again, list(keys), "left_semi").select(*columns).withColumn(GONE, F.lit(False))
            new = new.join(again, list(keys), "left_anti").select(*columns)
        added.append(_add_files(new, path, keys, False, load))
    over = done.filter(F.col(ACTION) != "insert").select(*columns, (F.col(ACTION) == "remove").alias(GONE))
    if back is not None and not back.isEmpty():
        over = over.unionByName(back)
    elif kinds <= {"insert"}:
        over = None
    if over is not None:
        added.append(_add_files(over, path, keys, True, load))
    if added:
        _publish(spark, path, schema, [listed, *added])
    return Upsert(read, done.filter(F.col(ACTION) != "remove").select(*columns, ACTION), done.filter("_before IS NOT NULL").select("_before.*"))


def compact_ranges(spark: SparkSession, path: str, keys: Sequence[str], small_rows: int = 100_000) -> int:
    """Fold overrides, and base files of fewer rows than ``small_rows``, into new base files; returns how many files went.

    Base files that no override touches and that are large enough stay as they are."""
    keys, listed, schema = list(keys), file_list(spark, path), _columns(spark, path)
    over = [r["file"] for r in listed.filter("overrides").select("file").collect()]
    gone = listed.filter("NOT overrides").filter(F.col("rows") < small_rows)
    if over:
        newest = _open(spark, path, schema, over).select(keys[0])
        gone = gone.unionByName(touched_files(listed.filter("NOT overrides"), newest, keys[0])).dropDuplicates(["file"])
    files = gone.select("file", "overrides").collect()
    if not over and len(files) < 2:
        return 0
    load = listed.agg(F.max("load")).first()[0] + 1
    rows = _merged(spark, path, keys, schema, files + listed.filter("overrides").select("file", "overrides").collect())
    names = [r["file"] for r in files] + over
    # The rows of files that stay are not among the overrides: these touch none of them.
    added = _add_files(rows, path, keys, False, load)
    _publish(spark, path, schema, [listed.join(spark.createDataFrame([(n,) for n in names], "file string"), "file", "left_anti"), added])
    return len(names)


def remove_unlisted(spark: SparkSession, path: str) -> int:
    """Delete files that the list does not name, and old lists. Readers of older states must be done."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path.rstrip('/')}/files")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named, gone = {r["file"] for r in file_list(spark, path).select("file").collect()}, 0
    for folder in fs.listStatus(root):
        inside = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")]
        old = [p for p in inside if f"{folder.getPath().getName()}/{p.getName()}" not in named]
        if inside and len(old) == len(inside):
            fs.delete(folder.getPath(), True)
        else:
            for p in old:
                fs.delete(p, False)
        gone += len(old)
    sink.remove_versions(spark, _list_path(path), keep=1)
    return gone
