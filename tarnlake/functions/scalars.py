"""Column expressions shared by the plans. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEVER = 999  # days or months reported when the event has not happened yet


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(date: Column | str) -> Column:
    """Calendar key, yyyymmdd as an integer."""
    d = _col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (unknown counts as 0)."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column | str, denominator: Column | str, at_zero=0.0) -> Column:
    """Division that gives ``at_zero`` for a zero denominator."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d == 0, F.lit(at_zero).cast("double")).otherwise(
        n.cast("double") / d.cast("double")
    )


def growth(current: Column | str, previous: Column | str, on_null: float | None = 0.0) -> Column:
    """Relative change; 0 after a zero period, ``on_null`` without a previous period."""
    c, p = _col(current), _col(previous)
    change = (c.cast("double") - p.cast("double")) / p.cast("double")
    return (
        F.when(p.isNull(), F.lit(on_null).cast("double")).when(p == 0, F.lit(0.0)).otherwise(change)
    )


def direction(change: Column | str, band: float = 0.1) -> Column:
    """1 above the band, -1 below it, 0 inside it or when unknown."""
    c = _col(change)
    return F.when(c > band, 1).when(c < -band, -1).otherwise(0)


def margin(revenue: Column | str, cost: Column | str) -> Column:
    r, c = _col(revenue), _col(cost)
    return ratio(r - c, r)


def profit_status(profit: Column | str) -> Column:
    return F.when(_col(profit) < 0, "Not Profitable").otherwise("Profitable")


def short_name(name: Column | str) -> Column:
    """Capital initial, first digit run, dash, trailing digit run."""
    n = _col(name)
    return F.concat(
        F.upper(F.left(n, F.lit(1))),
        F.regexp_extract(n, r"(\d+)", 1),
        F.lit("-"),
        F.regexp_extract(n, r"(\d+)$", 1),
    )


def blank(value: Column | str) -> Column:
    """Null, or nothing but spaces in its text form."""
    v = _col(value)
    return v.isNull() | (F.trim(v.cast("string")) == "")


def days_since(today: Column | str, event: Column | str) -> Column:
    return F.coalesce(F.datediff(_col(today), _col(event)), F.lit(NEVER))


def calendar_parts(date: Column | str) -> dict[str, Column]:
    """Day and month numbers used by the feature tables (Sunday is day 1)."""
    d = _col(date)
    return {
        "DayNumberOfWeek": F.dayofweek(d),
        "IsWeekend": flag(F.dayofweek(d).isin(1, 7)),
        "MonthNumberOfYear": F.month(d),
        "DayNumberOfMonth": F.dayofmonth(d),
    }


def customer_type(person_id: Column | str, store_id: Column | str) -> Column:
    return (
        F.when(_col(person_id).isNotNull(), "PERSON")
        .when(_col(store_id).isNotNull(), "STORE")
        .otherwise("NOT REGISTERED")
    )


def repaired_category(category: Column | str, subcategory: Column | str, value: Column | str) -> Column:
    """Products with neither level registered, or with a missing one, read Miscellaneous."""
    both = (_col(category) == "Not registered") & (_col(subcategory) == "Not registered")
    return F.when(both | _col(value).isNull(), "Miscellaneous").otherwise(_col(value))
