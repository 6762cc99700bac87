"""Type-1 upsert as a join that yields the next version of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.operators.keys import highest_key, number_rows
from tarnlake.session import checkpointed

ACTION = "merge_action"


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys met more than once; a merge must not choose between them."""
    return (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def reject_duplicates(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = duplicate_keys(source, keys).limit(1).collect()
    if found:
        raise ValueError(f"merge source has several rows for key {found[0].asDict()}")
    return source


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, failing the job at a second row for a key. The check rides on the
    shuffle and sort by key that the merge join needs anyway."""
    w = Window.partitionBy(*keys).orderBy(*keys)
    message = F.lit(f"merge source has several rows for one key {list(keys)}")
    only = F.when(F.col("_nth") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return source.withColumn("_nth", F.row_number().over(w)).filter(only).drop("_nth")


def differs_from(compare: Sequence[str]) -> Column:
    """Whether a compared column of t and s differs, nulls being equal."""
    changed = F.lit(False)
    for c in compare:
        changed = changed | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    return changed


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    sk: str | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Next version of ``target``, each row tagged insert, update or keep.

    Rows only the target has stay as they are; matched rows take the source values
    when any compared column differs (null-safely); the rest are added, with the next
    surrogate keys when ``sk`` is named. Keys are unique on both sides, so the join
    has no skew to split.
    """
    if check_source:
        source = unique_source(source, keys)
    columns = [c for c in target.columns]
    if sk is None:
        joined = target.withColumn("_t", F.lit(1)).alias("t").join(
            source.withColumn("_s", F.lit(1)).alias("s"),
            [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys],
            "full_outer",
        )
        action = (
            F.when(F.col("t._t").isNull(), "insert")
            .when(F.col("s._s").isNotNull() & differs_from(compare), "update")
            .otherwise("keep")
        )
        tagged = joined.withColumn(ACTION, action)
        picked = [
            F.coalesce(f"t.{c}", f"s.{c}").alias(c)
            if c in keys
            else F.when(F.col(ACTION) == "keep", F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
            for c in columns
        ]
        return tagged.select(*picked, ACTION)

    joined = target.withColumn("_t", F.lit(1)).alias("t").join(
        source.withColumn("_s", F.lit(1)).alias("s"),
        [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys],
        "full_outer",
    )
    action = (
        F.when(F.col("t._t").isNull(), "insert")
        .when(F.col("s._s").isNotNull() & differs_from(compare), "update")
        .otherwise("keep")
    )
    tagged = joined.withColumn(ACTION, action)
    taken = set(compare)

    def pick(c: str):
        if c == sk:
            return F.col(f"t.{c}")
        if c in keys:
            return F.coalesce(f"t.{c}", f"s.{c}")
        fresh = F.col(ACTION) == "insert"
        return F.when(fresh | (F.col(ACTION) == "update") if c in taken else fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    # Stored once: both sides are read a single time, and the new rows are numbered from what is stored.
    done = checkpointed(tagged.select(*[pick(c).alias(c) for c in columns], ACTION))
    added = number_rows(done.filter(F.col(ACTION) == "insert").drop(sk), keys, sk, highest_key(done, sk) + 1)
    return done.filter(F.col(ACTION) != "insert").unionByName(added.select(*columns, ACTION))


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated and kept rows."""
    return merged.agg(
        *[
            F.count(F.when(F.col(ACTION) == a, 1)).alias(name)
            for a, name in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))
        ]
    )
