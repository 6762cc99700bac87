"""Exact quantiles without gathering the values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import checkpointed


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list:
    """Value at rank ``ceil(p * n)`` for each probability.

    Values are counted, range-partitioned and checkpointed; the driver sees one total
    per partition, picks the partition holding the wanted rank, and only that
    partition's counts are summed up in order.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    placed = checkpointed(
        counts.repartitionByRange(column).withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(F.sum("_n").alias("n")).orderBy("_part").collect()
    n = sum(t["n"] for t in totals)
    if not n:
        return [None for _ in probabilities]
    out = []
    running = F.sum("_n").over(Window.orderBy(column))
    for p in probabilities:
        rank = min(max(math.ceil(p * n), 1), n)
        before = 0
        for t in totals:
            if before + t["n"] >= rank:
                break
            before += t["n"]
        here = placed.filter(F.col("_part") == t["_part"]).withColumn("_run", running + before)
        out.append(here.filter(F.col("_run") >= rank).agg(F.min(column)).first()[0])
    return out


def exact_cuts(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, list[float]]:
    """For every column the distinct values at ranks ceil(j / parts * n), j below ``parts``, in one pass.

    Values are counted and range-partitioned; a partition needs only the totals of those before it. The driver sees fewer
    than ``parts`` values of each column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns)])).alias("x")).select("x.*")
    counts = long.filter("v IS NOT NULL").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = checkpointed(counts.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("k", "part").agg(F.sum("n").alias("m"))
    whole = Window.partitionBy("k")
    offsets = totals.select(
        "k", "part", F.coalesce(F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.sum("m").over(whole).alias("all"))
    after = F.col("offset") + F.sum("n").over(Window.partitionBy("part", "k").orderBy("v"))
    ranked = placed.join(F.broadcast(offsets), ["k", "part"]).withColumn("after", after)
    met = ranked.filter(F.expr(f"least((after * {parts}) div all, {parts - 1}) > ((after - n) * {parts}) div all"))
    out: dict[str, list[float]] = {c: [] for c in columns}
    for r in met.select("k", "v").orderBy("k", "v").collect():
        out[columns[r["k"]]].append(r["v"])
    return out
