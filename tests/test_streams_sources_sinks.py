import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnlake.sinks import tables as sink
from tarnlake.sources import snapshots, wanted
from tarnlake.sources.documents import api_currency, api_weather, place_from_path
from tarnlake.streaming import ingest as st


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def drain(spark, tmp, run_id):
    return st.ingest(
        spark, str(tmp / "in"), "json", "data string", str(tmp / "cp"), str(tmp / "out"), run_id,
        glob="Currency_*.json", extra={"CurrencyDate": st.file_date(r"Currency_(\d{2}-\d{2}-\d{4})", "MM-dd-yyyy")})


def test_drain_takes_new_files_once(spark, rows, tmp_path):
    put(tmp_path / "in", "Currency_01-31-2024.json", '{"data": {"EUR": 0.9, "BRL": 4.956}}\n')
    put(tmp_path / "in", "other.json", '{"data": {"EUR": 1}}\n')
    first = drain(spark, tmp_path, "r1")
    assert (first.read, first.written) == (1, 1)
    assert drain(spark, tmp_path, "r2").written == 0
    put(tmp_path / "in", "Currency_02-01-2024.json", '{"data": {"EUR": 0.91}}\n{"data": {"EUR": 0.92}}\n')
    assert drain(spark, tmp_path, "r3").written == 2
    table = spark.read.parquet(str(tmp_path / "out"))
    assert rows(table, "CurrencyDate", "IngestRunID") == [
        (date(2024, 1, 31), "r1"), (date(2024, 2, 1), "r3"), (date(2024, 2, 1), "r3")]
    assert table.filter("IngestionDate is null or FileSource not like '%Currency_%'").count() == 0
    assert st.this_run(table, "r3").count() == 2
    assert rows(api_currency(st.this_run(table, "r1"))) == [(date(2024, 1, 31), "BRL", 4.96), (date(2024, 1, 31), "EUR", 0.9)]


def test_file_without_a_date_gives_null(spark, tmp_path):
    put(tmp_path / "in", "Currency_latest.json", '{"data": {"EUR": 0.9}}\n')
    drain(spark, tmp_path, "r1")
    assert spark.read.parquet(str(tmp_path / "out")).first().CurrencyDate is None


def test_documents_over_several_lines(spark, rows, tmp_path):
    put(tmp_path / "in", "a.json", '[\n {"name": "X",\n  "lat": 1.5},\n {"name": "Y", "lat": 2}\n]')
    put(tmp_path / "in", "b.json", '{\n "name": "Z"\n}')
    stats = st.ingest(
        spark, str(tmp_path / "in"), "json", "name string, lat double", str(tmp_path / "cp"), str(tmp_path / "out"),
        "r", options={"multiLine": True})
    assert stats.written == 3
    assert rows(spark.read.parquet(str(tmp_path / "out")), "name", "lat") == [("X", 1.5), ("Y", 2.0), ("Z", None)]


def test_csv_files_go_to_their_own_tables(spark, rows, tmp_path):
    put(tmp_path / "in", "head_2010.csv", "1,x,\n2,y,z\n")
    put(tmp_path / "in", "line_2010.csv", "7,8\n")
    stats = st.ingest_csv(
        spark, str(tmp_path / "in"), {"heads": ("head_*.csv", 3), "lines": ("line_*.csv", 2)}, str(tmp_path / "out"), "r")
    assert {k: v.written for k, v in stats.items()} == {"heads": 2, "lines": 1}
    heads = spark.read.parquet(str(tmp_path / "out" / "heads"))
    assert rows(heads, "_c0", "_c1", "_c2") == [("1", "x", None), ("2", "y", "z")]


def test_table_to_table_stream_passes_only_new_rows(spark, rows, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1,)], "v int").write.parquet(src)

    def run():
        return st.stream_table(
            spark, src, "v int", str(tmp_path / "cp"), str(tmp_path / "out"), "r", lambda df: df.withColumn("w", F.col("v") * 2))

    assert run().written == 1
    spark.createDataFrame([(2,)], "v int").write.mode("append").parquet(src)
    assert run().written == 1
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, 2), (2, 4)]


def test_weather_arrays_of_unequal_length(spark, rows):
    doc = '{"time": ["2024-01-01", "bad"], "temperature_2m_mean": [1.5], "precipitation_sum": [0, 1], "rain_sum": null}'
    raw = spark.createDataFrame([("/x/Rio_RJ_Brasil.json", 1.0, 2.0, doc)], "FileSource string, latitude double, longitude double, daily string")
    assert rows(api_weather(raw), "City", "Country", "FullDate", "Temperature", "Precipitation", "Rain") == [
        ("Rio", "Brasil", None, None, 1.0, None), ("Rio", "Brasil", date(2024, 1, 1), 1.5, 0.0, None)]


def test_place_without_all_parts(spark):
    df = spark.createDataFrame([("/x/Rio.json",)], "p string")
    assert tuple(df.select(*place_from_path(F.col("p")).values()).first()) == ("Rio", None, None)


def test_newest_snapshot_per_table(spark, rows, tmp_path):
    for stamp, value in (("01-02-2024", 1), ("01-01-2024", 2)):  # the later written one wins, whatever its name
        tables = {"T1": spark.createDataFrame([(value,)], "v int"), "skip": spark.range(1)}
        snapshots.extract_schema(tables, "Sales", str(tmp_path), stamp, exclude=["skip"])
        time.sleep(1.1)
    found = snapshots.read_latest(spark, str(tmp_path))
    assert list(found) == ["sales_t1"]
    assert rows(found["sales_t1"]) == [(2,)]


def test_extract_overrides_and_evolution(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "id int, v double")
    old, = snapshots.extract_schema({"t": df}, "s", str(tmp_path), "a", overrides={"t": ["id"]})
    new, = snapshots.extract_schema({"t": df}, "s", str(tmp_path), "b")
    want = [(1, 2.5), (1, None)]
    assert rows(snapshots.read_evolving(spark, old, new), "id", "v") == want
    assert rows(snapshots.append_evolving(spark.read.parquet(old), spark.read.parquet(new)), "id", "v") == want


def test_catalog_exclusions(spark, rows):
    catalog = spark.createDataFrame([("s", "a"), ("s", "b")], "schema string, table string")
    assert rows(snapshots.catalog_without(catalog, catalog.filter("table = 'a'"))) == [("s", "b")]


def test_wanted_keys_without_landed_files(spark, rows):
    places = spark.createDataFrame([("A", "S", "C"), ("B", "S", "C")], "City string, StateProvince string, Country string")
    files = spark.createDataFrame([("file:/x/A_S_C.json",)], "path string")
    assert rows(wanted.not_landed(places, wanted.place_key(places), files)) == [("B", "S", "C")]


def test_modes(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "d date")
    assert wanted.by_mode(df, "d", "history").count() == 2
    assert rows(wanted.by_mode(df, "d", "latest")) == [(date(2024, 1, 3),)]
    assert wanted.by_mode(df, "d", "latest", "2023-12-31").count() == 2
    with pytest.raises(ValueError):
        wanted.by_mode(df, "d", "other")


def test_overwrite_makes_versions_and_ignores_unfinished_ones(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sink.read_current(spark, path)
    assert sink.overwrite(spark.range(3), path) == 3
    # A job may read the table it replaces, and change its columns.
    assert sink.overwrite(sink.read_current(spark, path).withColumn("x", F.lit(1)).filter("id > 0"), path) == 2
    (tmp_path / "t" / "v=00000009").mkdir()
    assert rows(sink.read_current(spark, path)) == [(1, 1), (2, 1)]
    assert spark.read.parquet(f"{path}/v=00000001").count() == 3


def test_appending_a_batch_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.append_new(spark.range(3), path, ["id"]) == 3
    assert sink.append_new(spark.range(5), path, ["id"]) == 2
    assert spark.read.parquet(path).count() == 5


def test_feature_table_with_a_broken_key(spark, tmp_path):
    with pytest.raises(ValueError, match="duplicate"):
        sink.replace_feature_table(spark.range(2).select(F.lit(1).alias("k")), str(tmp_path / "f"), ["k"])


def test_comments_reach_the_catalog(spark):
    df = sink.with_comments(spark.range(1).select("id", F.lit("a").alias("v")), {"id": "the key"})
    df.write.mode("overwrite").saveAsTable("commented")
    sink.comment_table(spark, "commented", {"v": "it's a value"})
    got = {r.col_name: r.comment for r in spark.sql("DESCRIBE commented").collect()}
    assert got == {"id": "the key", "v": "it's a value"}


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sink.overwrite_bucketed(spark.range(100).select("id", F.lit(1).alias("a")), "left_b", ["id"], 4)
        sink.overwrite_bucketed(spark.range(100).select("id", F.lit(2).alias("b")), "right_b", ["id"], 4)
        joined = spark.table("left_b").join(spark.table("right_b"), "id")
        assert joined.count() == 100
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_broken_key_is_never_published(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.replace_feature_table(spark.range(3), path, ["id"])
    with pytest.raises(ValueError):
        sink.replace_feature_table(spark.range(2).select(F.lit(1).cast("long").alias("id")), path, ["id"])
    assert sink.read_current(spark, path).count() == 3
    sink.replace_feature_table(spark.range(5), path, ["id"])
    assert sink.read_current(spark, path).count() == 5
    assert sink.remove_versions(spark, path, keep=1) == [1] and sink.read_current(spark, path).count() == 5


def test_an_append_takes_one_row_of_a_key(spark, tmp_path):
    assert sink.append_new(spark.createDataFrame([(1,), (1,), (2,)], "id long"), str(tmp_path / "a"), ["id"]) == 2


def test_unfinished_snapshots_are_passed_over(spark, tmp_path):
    from tarnlake.sources import snapshots

    root = tmp_path / "land"
    for day in ("01-01-2024", "01-02-2024"):
        spark.range(1).write.parquet(str(root / "sales" / "store" / f"store_{day}.parquet"))
    (root / "sales" / "store" / "store_01-02-2024.parquet" / "_SUCCESS").unlink()
    found = snapshots.latest_snapshots(spark, str(root)).collect()
    assert [r.table_name for r in found] == ["sales_store"] and found[0].snapshot.endswith("store_01-01-2024.parquet")


def test_rows_of_a_run_read_only_its_partition(spark, tmp_path):
    land, out = tmp_path / "in", str(tmp_path / "out")
    spark.range(4).write.json(str(land))
    stats = st.ingest(spark, str(land), "json", "id long", str(tmp_path / "c"), out, "run-a")
    assert (stats.read, stats.written) == (4, 4)
    picked = st.this_run(spark.read.parquet(out), "run-a")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert picked.count() == 4 and "PartitionFilters: [isnotnull(IngestRunID" in plan


def test_counts_are_whole_when_a_report_is_lost(spark, tmp_path, monkeypatch):
    """Whichever report of a run is withheld, the checkpoint tells that a batch is missing."""
    from pyspark.sql.streaming import StreamingQuery

    from tarnlake.streaming.ingest import ingest

    real = StreamingQuery.recentProgress.fget
    for lost in (None, 0, 2, 4):
        folder = tmp_path / f"lost-{lost}"
        for k in range(5):
            spark.range(k + 1).coalesce(1).write.mode("append").json(str(folder / "in"))
        monkeypatch.setattr(StreamingQuery, "recentProgress", property(lambda q, x=lost: [p for p in real(q) if p["batchId"] != x]))
        stats = ingest(
            spark, str(folder / "in"), "json", "id long", str(folder / "check"), str(folder / "out"), "r1", options={"maxFilesPerTrigger": 1})
        assert stats.written == 15 and stats.reported == (lost is None) and stats.read == 15
        assert stats.batches == 5 - (lost is not None)
        # A second run has nothing to do, and no report to miss.
        again = ingest(spark, str(folder / "in"), "json", "id long", str(folder / "check"), str(folder / "out"), "r2")
        assert (again.read, again.written, again.reported) == (0, 0, True)
