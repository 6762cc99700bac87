"""The cleaning recipe: project, look up, require keys, keep one row per key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.dedup import dedup


@dataclass(frozen=True)
class Lookup:
    table: str
    alias: str
    on: str
    how: str = "left"


@dataclass(frozen=True)
class Part:
    """One input branch of a cleaned table."""

    table: str
    columns: Mapping[str, str]
    lookups: tuple[Lookup, ...] = ()


@dataclass(frozen=True)
class CleanSpec:
    name: str
    parts: tuple[Part, ...]
    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = field(default=())


def _project(tables: Mapping[str, DataFrame], part: Part) -> DataFrame:
    df = tables[part.table].alias("b")
    for lk in part.lookups:
        df = df.join(tables[lk.table].alias(lk.alias), F.expr(lk.on), lk.how)
    return df.select(*[F.expr(e).alias(c) for c, e in part.columns.items()])


def clean(tables: Mapping[str, DataFrame], spec: CleanSpec) -> DataFrame:
    """Run one spec. Lookups carry no hint: Spark broadcasts a side only when its
    measured size is under the threshold and sorts and merges otherwise."""
    df = _project(tables, spec.parts[0])
    for part in spec.parts[1:]:
        df = df.unionByName(_project(tables, part))
    for column in spec.required:
        df = df.filter(F.col(column).isNotNull())
    return dedup(df, spec.keys, spec.order) if spec.keys else df
