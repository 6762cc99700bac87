"""Nested landing documents to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The daily weather document as the landing files hold it.
WEATHER_DAILY = (
    "time array<string>, temperature_2m_mean array<double>, precipitation_sum array<double>, "
    "rain_sum array<double>, snowfall_sum array<double>"
)


def explode_map(
    df: DataFrame, column: str, key: str, value: str, digits: int | None = None
) -> DataFrame:
    """JSON object text -> one row per entry, the value rounded when asked."""
    kept = [c for c in df.columns if c != column]
    rows = df.select(
        *kept, F.explode(F.from_json(column, "map<string,double>")).alias(key, value)
    )
    return rows if digits is None else rows.withColumn(value, F.round(value, digits))


def zip_arrays(df: DataFrame, column: str, schema: str, names: Mapping[str, str]) -> DataFrame:
    """JSON object of parallel arrays -> one row per position. ``names`` maps array
    field to output column. A shorter or absent array gives nulls, not fewer rows."""
    kept = [c for c in df.columns if c != column]
    parsed = df.select(*kept, F.from_json(column, schema).alias("_doc"))
    zipped = F.arrays_zip(*[F.coalesce(f"_doc.{f}", F.array()).alias(f) for f in names])
    rows = parsed.select(*kept, F.explode(zipped).alias("_row"))
    return rows.select(*kept, *[F.col(f"_row.{f}").alias(o) for f, o in names.items()])


def file_stem(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def place_from_path(path: Column) -> dict[str, Column]:
    """City, state and country out of ``<city>_<state>_<country>.json``."""
    parts = F.split(file_stem(path), "_")
    return {
        n: F.get(parts, F.lit(i)) for i, n in enumerate(("City", "StateProvince", "Country"))
    }


def api_currency(raw: DataFrame) -> DataFrame:
    """One row per rate date and currency code, rates with two decimals."""
    return explode_map(raw.select("CurrencyDate", "data"), "data", "CurrencyCode", "Rate", 2)


def api_weather(raw: DataFrame) -> DataFrame:
    """One row per place and day from the daily arrays of the history files."""
    placed = raw.select(
        *[c.alias(n) for n, c in place_from_path(F.col("FileSource")).items()],
        "latitude",
        "longitude",
        "daily",
    )
    rows = zip_arrays(
        placed,
        "daily",
        WEATHER_DAILY,
        {
            "time": "FullDate",
            "temperature_2m_mean": "Temperature",
            "precipitation_sum": "Precipitation",
            "rain_sum": "Rain",
            "snowfall_sum": "Snowfall",
        },
    )
    return rows.withColumn("FullDate", F.expr("try_cast(FullDate as date)"))
