"""Ingestion: the given tables are landed as files, drained by streams and read back."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.clean import shaped
from checks.common import Registry, q, tidy
from checks.mapping import Tables, with_tables
from tarnlake.operators.cleaning import clean
from tarnlake.plans import raw
from tarnlake.plans.clean_tables import ORDER_DETAIL, ORDER_HEADER, SPECS
from tarnlake.session import fresh_folder
from tarnlake.sources import snapshots, wanted
from tarnlake.sources.documents import api_currency, api_weather
from tarnlake.streaming import ingest as st

SPLIT_DAY = "2024-01-16"
SPLIT = re.compile(r",\s*(?=CAST|c_)")


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Currency documents: one folder per day, named as the daily files are.

def land_currency(events, path: str) -> None:
    (
        events.select(
            F.concat(F.lit("Currency_"), F.date_format("ts", "MM-dd-yyyy")).alias("landing"),
            F.concat(F.lit('{"data": '), "props", F.lit("}")).alias("value"),
        ).write.mode("append").partitionBy("landing").text(path)
    )


def drain_currency(spark, path: str, root: str, run_id: str) -> st.IngestStats:
    return st.ingest(
        spark, path, "json", "data string", f"{root}/_checkpoints/currency", f"{root}/api_currencies", run_id,
        options={"recursiveFileLookup": True},
        extra={"CurrencyDate": st.file_date(r"Currency_(\d{2}-\d{2}-\d{4})", "MM-dd-yyyy")},
    )


def two_drains(spark, sf_dir: str):
    """Land and drain the first days, then the rest; returns the table and both runs."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    events = table(spark, sf_dir, "events")
    runs = []
    for run_id, part in (("first", F.col("ts") < SPLIT_DAY), ("second", F.col("ts") >= SPLIT_DAY)):
        land_currency(events.filter(part), landing)
        runs.append(drain_currency(spark, landing, root, run_id))
    runs.append(drain_currency(spark, landing, root, "idle"))
    return spark.read.parquet(f"{root}/api_currencies"), runs


def bronze_currency(spark, sf_dir: str):
    return two_drains(spark, sf_dir)[0].select("CurrencyDate", "data", "IngestRunID")


def metadata_counts(spark, sf_dir: str):
    return two_drains(spark, sf_dir)[0].groupBy("IngestRunID").agg(
        F.count("IngestionDate").alias("with_time"),
        F.count(F.when(F.col("FileSource").contains("Currency_"), 1)).alias("with_file"),
    )


def second_run(spark, sf_dir: str):
    return st.this_run(two_drains(spark, sf_dir)[0], "second").select("CurrencyDate", "data")


def stream_counts(spark, sf_dir: str):
    runs = two_drains(spark, sf_dir)[1]
    return spark.createDataFrame(
        [(r.run_id, r.read, r.written) for r in runs], "run string, read bigint, written bigint"
    )


# Documents over several lines, one per place.

def places(spark, sf_dir: str):
    t = Tables(spark, sf_dir)
    return t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_mktsegment").alias("City"), F.col("n_name").alias("StateProvince"),
        F.concat(F.lit("C"), F.col("n_regionkey")).alias("Country"), F.col("n_nationkey").alias("n"),
    ).distinct()


def land_places(rows, path: str) -> None:
    doc = F.concat(
        F.lit('[{\n  "country": "'), "Country", F.lit('",\n  "name": "'), "City",
        F.lit('",\n  "state": "'), "StateProvince", F.lit('",\n  "lat": '), F.col("n") / 2,
        F.lit(',\n  "lon": '), F.col("n") * 2, F.lit("\n}]"),
    )
    rows.select(
        F.concat_ws("_", "City", F.translate("StateProvince", "_", "-"), "Country").alias("place"), doc.alias("value")
    ).write.partitionBy("place").text(path)


def geocoding(spark, sf_dir: str):
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    land_places(places(spark, sf_dir), landing)
    st.ingest(
        spark, landing, "json", "country string, name string, lat double, lon double, state string",
        f"{root}/_checkpoints/geo", f"{root}/api_geocoding", "geo",
        options={"multiLine": True, "recursiveFileLookup": True},
    )
    return spark.read.parquet(f"{root}/api_geocoding").select("country", "name", "lat", "lon", "state")


def weather(spark, sf_dir: str):
    """Daily order figures of a nation as its weather document, drained to the raw table
    and from there, table to table, to rows per place and day. A document has one entry
    per calendar day."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    t = Tables(spark, sf_dir)
    daily = (
        t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date("o_orderdate").cast("string").alias("d"))
        .agg(F.max("o_totalprice").alias("v"), F.count(F.lit(1)).cast("double").alias("n"))
    )
    entries = F.sort_array(F.collect_list(F.struct("d", "v", "n")))
    docs = daily.groupBy("c_nationkey").agg(entries.alias("e")).select(
        F.concat(F.lit("N"), "c_nationkey", F.lit("_S"), "c_nationkey", F.lit("_Land")).alias("place"),
        F.to_json(F.struct(
            F.col("c_nationkey").cast("double").alias("latitude"),
            F.lit(1.5).alias("longitude"),
            F.struct(
                F.col("e.d").alias("time"), F.col("e.v").alias("temperature_2m_mean"),
                F.col("e.n").alias("precipitation_sum"), F.col("e.n").alias("rain_sum"),
                F.col("e.v").alias("snowfall_sum")).alias("daily"),
        ), {"pretty": "true"}).alias("value"),
    )
    docs.write.partitionBy("place").text(landing)
    schema = "latitude double, longitude double, daily string"
    st.ingest(
        spark, landing, "json", schema, f"{root}/_checkpoints/weather", f"{root}/weather", "weather",
        options={"multiLine": True, "recursiveFileLookup": True},
        transform=lambda df: df.withColumn(
            "FileSource", F.regexp_replace("FileSource", r"place=([^/]*)/[^/]*$", "$1.json")),
    )
    st.stream_table(
        spark, f"{root}/weather", f"{schema}, FileSource string", f"{root}/_checkpoints/silver",
        f"{root}/silver", "silver", api_weather)
    return tidy(spark.read.parquet(f"{root}/silver"))


def csv_history(spark, sf_dir: str, name: str):
    """History files without header, drained as text columns, cleaned with the live rows."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    t = Tables(spark, sf_dir)
    header, detail = "csv_salesorderheader", "csv_salesorderdetail"
    for raw in (header, detail):
        t[raw].write.option("header", False).csv(f"{landing}/{raw}")
    runs = {
        raw: st.ingest(
            spark, f"{landing}/{raw}", "csv", st.positional_schema(n), f"{root}/_checkpoints/{raw}",
            f"{root}/{raw}", "csv", glob="*.csv", options={"header": False, "sep": ","})
        for raw, n in ((header, len(ORDER_HEADER)), (detail, len(ORDER_DETAIL)))
    }
    assert all(r.written == r.read for r in runs.values())
    raw_tables = {
        header: spark.read.parquet(f"{root}/{header}"), detail: spark.read.parquet(f"{root}/{detail}"),
        "sales_salesorderheader": t["sales_salesorderheader"], "sales_salesorderdetail": t["sales_salesorderdetail"],
    }
    return tidy(clean(raw_tables, SPECS[name]))


# Snapshots of tables.

def extracted(spark, sf_dir: str) -> str:
    """Two snapshots of three tables, the first of customer without its segment."""
    root = fresh_folder(spark, "landing")
    t = {n: table(spark, sf_dir, n) for n in ("customer", "supplier", "region")}
    snapshots.extract_schema(
        {**t, "customer": t["customer"].drop("c_mktsegment")}, "sales", root, "01-01-2024", exclude=["region"])
    snapshots.extract_schema(
        t, "sales", root, "01-02-2024",
        overrides={"supplier": ["s_suppkey", "s_name", "cast(s_acctbal as string) as s_acctbal"]}, exclude=["region"])
    return root


def discovered(spark, sf_dir: str):
    found = snapshots.snapshot_tables(snapshots.list_files(spark, extracted(spark, sf_dir)))
    return found.groupBy("table_name").agg(F.count_distinct("snapshot").alias("snapshots"))


def newest(spark, sf_dir: str):
    return snapshots.read_latest(spark, extracted(spark, sf_dir))["sales_customer"]


def newest_overridden(spark, sf_dir: str):
    return snapshots.read_latest(spark, extracted(spark, sf_dir))["sales_supplier"]


def evolved(spark, sf_dir: str):
    root = extracted(spark, sf_dir)
    old, new = (
        spark.read.parquet(f"{root}/sales/customer/customer_{stamp}.parquet") for stamp in ("01-01-2024", "01-02-2024"))
    return snapshots.append_evolving(old, new)


def evolved_files(spark, sf_dir: str):
    root = extracted(spark, sf_dir)
    return snapshots.read_evolving(
        spark, *[f"{root}/sales/customer/customer_{stamp}.parquet" for stamp in ("01-01-2024", "01-02-2024")])


def fetch_dates(spark, sf_dir: str):
    return wanted.wanted_dates(
        [(table(spark, sf_dir, "orders"), "o_orderdate"), (table(spark, sf_dir, "lineitem"), "l_shipdate")], "1999-01-01")


def fetch_places(spark, sf_dir: str):
    t = Tables(spark, sf_dir)
    return wanted.wanted_places(
        t["person_address"].select(F.col("city").alias("City"), "stateprovinceid"),
        t["person_stateprovince"].select(
            F.col("name").alias("StateProvince"), "stateprovinceid", "countryregioncode", "territoryid"),
        t["person_countryregion"].select(F.col("name").alias("Country"), "countryregioncode"),
        t["sales_salesterritory"].select("territoryid"),
    )


def still_missing(spark, sf_dir: str):
    """Places landed for two segments only; the others are still to be fetched."""
    landing = fresh_folder(spark, "landing")
    all_places = places(spark, sf_dir)
    land_places(all_places.filter(F.col("City").isin("BUILDING", "MACHINERY")), landing)
    files = snapshots.list_files(spark, landing, "*.txt").select(
        F.regexp_replace("path", r"place=([^/]*)/[^/]*$", "$1.json").alias("path"))
    key = F.concat_ws("_", "City", F.translate("StateProvince", "_", "-"), "Country")
    return wanted.not_landed(all_places, key, files).drop("n")


_PLACES = """
    SELECT DISTINCT c_mktsegment AS City, n_name AS StateProvince, 'C' || n_regionkey AS Country, n_nationkey AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_EVENT_DATA = "CAST(ts AS DATE) AS CurrencyDate, props AS data"
_RUN = f"CASE WHEN ts < TIMESTAMP '{SPLIT_DAY}' THEN 'first' ELSE 'second' END"


def register(reg: Registry) -> None:
    reg.add("a01_ingest_json", bronze_currency, f"SELECT {_EVENT_DATA}, {_RUN} AS IngestRunID FROM events")
    reg.add("a02_ingest_multiline_places", geocoding, f"""
        SELECT Country AS country, City AS name, n / 2.0::DOUBLE AS lat, (n * 2)::DOUBLE AS lon, StateProvince AS state
        FROM ({_PLACES}) AS p""")
    reg.add("a03_ingest_weather_to_silver", weather, f"""
        SELECT 'N' || c_nationkey AS City, 'S' || c_nationkey AS StateProvince, 'Land' AS Country,
          c_nationkey::DOUBLE AS latitude, 1.5::DOUBLE AS longitude, o_orderdate::DATE AS FullDate,
          {q('max(o_totalprice)', 'Temperature')}, count(*)::DOUBLE AS Precipitation, count(*)::DOUBLE AS Rain,
          {q('max(o_totalprice)', 'Snowfall')}
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, o_orderdate::DATE""")
    reg.add("a04_ingest_csv_headers", lambda s, d: csv_history(s, d, "clean_sales_order_header"), shaped("clean_sales_order_header"))
    reg.add("a04_ingest_csv_details", lambda s, d: csv_history(s, d, "clean_sales_order_detail"), shaped("clean_sales_order_detail"))
    reg.add("a05_discover_snapshots", discovered,
            "SELECT * FROM (VALUES ('sales_customer', 2::BIGINT), ('sales_supplier', 2::BIGINT)) AS t(table_name, snapshots)")
    reg.add("a06_latest_snapshot", newest, "SELECT * FROM customer")
    reg.add("a07_schema_evolution", evolved,
            "SELECT * REPLACE (NULL AS c_mktsegment) FROM customer UNION ALL SELECT * FROM customer")
    reg.add("a07_schema_evolution_files", evolved_files,
            "SELECT * REPLACE (NULL AS c_mktsegment) FROM customer UNION ALL SELECT * FROM customer")
    reg.add("a08_ingestion_metadata", metadata_counts,
            f"SELECT {_RUN} AS IngestRunID, count(*) AS with_time, count(*) AS with_file FROM events GROUP BY ALL")
    reg.add("a09_date_from_file_name", lambda s, d: two_drains(s, d)[0].groupBy("CurrencyDate").count(),
            'SELECT CAST(ts AS DATE) AS CurrencyDate, count(*) AS "count" FROM events GROUP BY ALL')
    reg.add("a10_rows_of_this_run", second_run, f"SELECT {_EVENT_DATA} FROM events WHERE ts >= TIMESTAMP '{SPLIT_DAY}'")
    reg.add("a11_table_to_table_stream", table_to_table, """
        SELECT CAST(ts AS DATE) AS CurrencyDate, code AS CurrencyCode,
          CAST(json_extract(props, '$."' || code || '"') AS DOUBLE) AS Rate
        FROM (SELECT ts, props, unnest(json_keys(props)) AS code FROM events) AS e""")
    reg.add("a05_raw_tables_by_run", raw_tables, """
        SELECT 'sales_customer' AS table_name, 'run' || (c_custkey % 3) AS IngestRunID, count(*) AS "rows", sum(c_custkey)::BIGINT AS keys
        FROM customer GROUP BY ALL
        UNION ALL SELECT 'sales_supplier', 'run0', count(*), sum(s_suppkey)::BIGINT FROM supplier""")
    reg.add("a07_widened_raw_table", widened, """
        SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS c_mktsegment,
          'run' || (c_custkey % 3) AS IngestRunID FROM customer""")
    reg.add("a12_extracted_rows", newest_rows, """
        SELECT 'sales_customer' AS table_name, c_custkey AS "key", c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
          c_mktsegment AS mktsegment FROM customer
        UNION ALL SELECT 'sales_supplier', s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier""")
    reg.add("a12_extract_tables", newest_all, """
        SELECT 'sales_customer' AS table_name, count(*) AS "rows" FROM customer
        UNION ALL SELECT 'sales_supplier', count(*) FROM supplier""")
    reg.add("a13_extract_overrides", newest_overridden,
            "SELECT s_suppkey, s_name, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier")
    reg.add("a14_wanted_dates", fetch_dates, """
        SELECT CAST(o_orderdate AS DATE) AS WantedDate FROM orders WHERE o_orderdate >= DATE '1999-01-01'
        UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_shipdate >= DATE '1999-01-01'""")
    reg.add("a15_wanted_places", fetch_places, with_tables("""
        SELECT DISTINCT city AS City, s.name AS StateProvince, r.name AS Country FROM person_address a
          JOIN person_stateprovince s ON a.stateprovinceid = s.stateprovinceid
          JOIN person_countryregion r ON s.countryregioncode = r.countryregioncode
          JOIN sales_salesterritory t ON s.territoryid = t.territoryid"""))
    reg.add("a16_not_landed", still_missing,
            f"SELECT City, StateProvince, Country FROM ({_PLACES}) AS p WHERE City NOT IN ('BUILDING', 'MACHINERY')")
    reg.add("a17_history_mode", lambda s, d: mode(s, d, "history"), "SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")
    reg.add("a17_latest_mode", lambda s, d: mode(s, d, "latest"), """
        SELECT o_orderkey, o_orderdate::DATE AS d FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders)""")
    reg.add("h07_stream_counts", stream_counts, f"""
        SELECT run, count(*) AS "read", count(*) AS written FROM (SELECT {_RUN} AS run FROM events) AS e GROUP BY ALL
        UNION ALL SELECT 'idle', 0, 0""")


def mode(spark, sf_dir: str, name: str):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return wanted.by_mode(orders, "d", name)


# Three snapshots of a raw table: without a column, with narrower types, and as it is now.
SNAPSHOTS = (
    "CAST(c_custkey AS INT) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(10,2)) AS c_acctbal",
    "CAST(c_custkey AS INT) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment",
    "CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,3)) AS c_acctbal, c_mktsegment",
)


def raw_layer(spark, sf_dir: str):
    """A landed table drained after each of its snapshots, with another one that has a single snapshot."""
    land, root = fresh_folder(spark, "land"), fresh_folder(spark, "lake")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").write.parquet(f"{land}/sales/supplier/supplier_1.parquet")
    for k, columns in enumerate(SNAPSHOTS):
        customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
        part = customers.filter(F.col("c_custkey") % 3 == k).selectExpr(*[c.strip() for c in SPLIT.split(columns)])
        part.write.parquet(f"{land}/sales/customer/customer_{k}.parquet")
        if raw.raw_job(spark, land, root, f"run{k}"):
            raise RuntimeError("a table failed")
    return root


def widened(spark, sf_dir: str):
    """All rows of the raw table, read with the columns and types that its log of columns has grown to."""
    rows = raw.read_raw(spark, raw_layer(spark, sf_dir), "sales_customer")
    return rows.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment", "IngestRunID")


def raw_tables(spark, sf_dir: str):
    """Every raw table that was discovered, with its rows of each run."""
    root = raw_layer(spark, sf_dir)
    parts = [
        raw.read_raw(spark, root, n).groupBy("IngestRunID").agg(F.count("*").alias("rows"), F.sum(key).alias("keys")).select(
            F.lit(n).alias("table_name"), "IngestRunID", "rows", "keys")
        for n, key in (("sales_customer", "c_custkey"), ("sales_supplier", "s_suppkey"))]
    return parts[0].union(parts[1])


def newest_rows(spark, sf_dir: str):
    """Whole rows of every extracted table."""
    tables = snapshots.read_latest(spark, extracted(spark, sf_dir))
    columns = ("key", "name", "nationkey", "acctbal", "mktsegment")
    parts = []
    for n in sorted(tables):
        own = {c.split("_", 1)[1].replace("custkey", "key").replace("suppkey", "key"): c for c in tables[n].columns}
        parts.append(tables[n].select(
            F.lit(n).alias("table_name"), *[(F.col(own[c]).cast("double") if c == "acctbal" else F.col(own[c])).alias(c) for c in columns if c in own]))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def newest_all(spark, sf_dir: str):
    tables = snapshots.read_latest(spark, extracted(spark, sf_dir))
    counted = [
        df.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in tables.items()
    ]
    return counted[0].union(counted[1])


def table_to_table(spark, sf_dir: str):
    """Raw currency documents to rows, only what each run added."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    events = table(spark, sf_dir, "events")
    for run_id, part in (("first", F.col("ts") < SPLIT_DAY), ("second", F.col("ts") >= SPLIT_DAY)):
        land_currency(events.filter(part), landing)
        drain_currency(spark, landing, root, run_id)
        st.stream_table(
            spark, f"{root}/api_currencies", "data string, CurrencyDate date", f"{root}/_checkpoints/silver",
            f"{root}/api_currency", run_id, api_currency)
    return tidy(spark.read.parquet(f"{root}/api_currency"))

