"""First row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def parse_order(term: str):
    """``"EndDate desc"`` -> column; descending puts nulls last, ascending first."""
    name, _, way = term.partition(" ")
    return F.col(name).desc_nulls_last() if way.lower() == "desc" else F.col(name).asc_nulls_first()


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each key under a total order.

    The stated order is completed with all remaining columns, so the survivor does
    not depend on partitioning. Spark turns ``row_number() = 1`` into a group limit
    that runs before the shuffle: each task sends at most one row per key, so a hot
    key costs one row per upstream task.
    """
    named = {t.partition(" ")[0] for t in order}
    rest = [c for c in df.columns if c not in named and c not in keys]
    terms = [parse_order(t) for t in [*order, *rest]] or [F.col(keys[0])]
    w = Window.partitionBy(*keys).orderBy(*terms)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
