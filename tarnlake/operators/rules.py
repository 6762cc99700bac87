"""Which columns are checked for which table.

A rule book is data. It can be written by hand, read from a table with
``rules_from_table``, or derived with ``rules_from_specs``: a cleaned table must have
its required columns filled and its key unique.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from tarnlake.operators.cleaning import CleanSpec
from tarnlake.operators.quality import RECORD, quality
from tarnlake.session import checkpointed, shared_folder

METADATA = ("FileSource", "IngestionDate")
AT_ONCE = 4  # tables checked at the same time


@dataclass(frozen=True)
class Rule:
    check_null: tuple[str, ...] = ()
    check_dup: tuple[str | tuple[str, ...], ...] = ()


def rules_from_specs(specs: Iterable[CleanSpec]) -> dict[str, Rule]:
    book = {}
    for s in specs:
        keys = s.keys[0] if len(s.keys) == 1 else tuple(s.keys)
        book[s.name] = Rule(tuple(s.required), (keys,) if s.keys else ())
    return book


def rules_from_table(rows: DataFrame) -> dict[str, Rule]:
    """Rule book from (table_name, column_name, check_type) rows; small by nature,
    one row per rule."""
    book: dict[str, dict[str, list[str]]] = {}
    for r in rows.select("table_name", "column_name", "check_type").orderBy(*rows.columns).collect():
        book.setdefault(r[0], {"NULL": [], "DUPLICATE": []})[r[2]].append(r[1])
    return {t: Rule(tuple(c["NULL"]), tuple(c["DUPLICATE"])) for t, c in book.items()}


def select_rule(book: Mapping[str, Rule], table: str, layer: str) -> Rule | None:
    """Raw tables are found whatever the case of their name; cleaned ones exactly."""
    if layer == "BRONZE":
        return {k.lower(): v for k, v in book.items()}.get(table.lower())
    return book.get(table)


def apply_rules(
    df: DataFrame,
    book: Mapping[str, Rule],
    table: str,
    *,
    layer: str,
    run_id: str,
    process: str,
) -> DataFrame:
    """Quality log rows for the rules of one table. Columns the table lacks are
    skipped, a table without rules gives no rows, and raw tables also have their
    ingestion columns checked."""
    rule = select_rule(book, table, layer)
    if rule is None:
        return df.sparkSession.createDataFrame([], RECORD)
    have = {c.lower() for c in df.columns}  # columns are found whatever their case, as Spark does
    nulls = list(rule.check_null)
    if layer == "BRONZE":
        nulls += [c for c in METADATA if c not in nulls]
    nulls = [c for c in nulls if c.lower() in have]
    dups = [
        k for k in rule.check_dup if {c.lower() for c in ([k] if isinstance(k, str) else k)} <= have
    ] if nulls else []
    return quality(df, nulls, dups, run_id=run_id, process=process, layer=layer, table=table)


def apply_rules_to_all(
    tables: Mapping[str, DataFrame], book: Mapping[str, Rule], *, layer: str, run_id: str, process: str
) -> DataFrame:
    """Quality log rows of several tables, a few tables at a time: a table's rows are stored as soon as they are known, so
    shuffles are never on disk for all tables at once."""
    def checked(item: tuple[str, DataFrame]) -> DataFrame:
        return checkpointed(apply_rules(item[1], book, item[0], layer=layer, run_id=run_id, process=process))

    for df in tables.values():
        shared_folder(df.sparkSession)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return reduce(DataFrame.unionByName, pool.map(checked, tables.items()))
