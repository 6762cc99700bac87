"""Shared by the check modules: result shaping and oracle text helpers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, oracle: str | None = None) -> None:
        if name in self.queries:
            raise KeyError(name)
        self.queries[name] = query
        if oracle is not None:
            self.oracles[name] = oracle


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain result types: money as double, quotients rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # Plain arithmetic, so both engines round ties alike.
            scale = F.lit(10.0**digits)
            c = F.floor(c.cast("double") * scale + F.lit(0.5)).cast("double") / scale
        out.append(c.alias(f.name))
    return df.select(*out)


def m(expr: str, name: str | None = None) -> str:
    """Exact amount as double."""
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def q(expr: str, name: str, digits: int = 6) -> str:
    """Rounded quotient."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"floor(CAST({expr} AS DOUBLE) * {scale} + CAST(0.5 AS DOUBLE)) / {scale} AS {name}"


def first_row(select: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> str:
    """First row per key: stated order, then all other columns."""
    named = {o.split()[0] for o in order}
    terms = [f"{o} NULLS LAST" if o.lower().endswith(" desc") else f"{o} NULLS FIRST" for o in order]
    terms += [f"{c} NULLS FIRST" for c in columns if c not in named and c not in keys]
    ordering = f"ORDER BY {', '.join(terms)}" if terms else ""
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"{', '.join(keys)} {ordering}) AS _rn FROM ({select}) AS s) AS r WHERE _rn = 1"
    )
