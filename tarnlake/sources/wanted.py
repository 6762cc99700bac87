"""What still has to be fetched: wanted keys against landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.sources.documents import file_stem


def wanted_dates(frames: Sequence[tuple[DataFrame, str]], since: str) -> DataFrame:
    """Distinct dates of several tables from a cut-off on."""
    out = None
    for df, column in frames:
        days = df.select(F.to_date(column).alias("WantedDate")).filter(
            F.col("WantedDate") >= F.lit(since).cast("date")
        )
        out = days if out is None else out.union(days)
    return out.distinct()


def wanted_places(
    address: DataFrame, state: DataFrame, country: DataFrame, territory: DataFrame
) -> DataFrame:
    """Unique city, state, country of the addresses in a known territory."""
    return (
        address.join(state, "stateprovinceid")
        .join(country, "countryregioncode")
        .join(territory, "territoryid")
        .select("City", "StateProvince", "Country")
        .distinct()
        .orderBy("Country", "StateProvince", "City")
    )


def place_key(df: DataFrame) -> Column:
    """File stem a place lands under."""
    return F.concat_ws("_", df["City"], df["StateProvince"], df["Country"])


def not_landed(wanted: DataFrame, key: Column, files: DataFrame) -> DataFrame:
    """Wanted rows whose key is not the stem of a landed file."""
    landed = files.select(file_stem(F.col("path")).alias("_stem")).distinct()
    return (
        wanted.withColumn("_stem", key)
        .join(landed, "_stem", "left_anti")
        .drop("_stem")
    )


def by_mode(df: DataFrame, date: str, mode: str, since: str | None = None) -> DataFrame:
    """``history`` takes everything, ``latest`` only rows after ``since``, or the
    newest day when no mark is given."""
    if mode == "history":
        return df
    if mode != "latest":
        raise ValueError(f"unknown mode {mode!r}")
    if since is not None:
        return df.filter(F.col(date) > F.lit(since).cast("date"))
    newest = df.agg(F.max(date).alias("d")).scalar()
    return df.filter(F.col(date) == newest)
