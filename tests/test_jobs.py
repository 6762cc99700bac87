import time
from pathlib import Path

from pyspark.sql import functions as F

from tarnlake.operators.rules import Rule, apply_rules_to_all
from tarnlake.plans import jobs
from tarnlake.plans.clean_tables import SPECS
from tarnlake.session import shared_folder
from tarnlake.sinks import ranges
from tarnlake.sinks import tables as sink

TERRITORY = "territoryid int, name string, countryregioncode string, `group` string"


def raw(spark, *rows):
    return {"sales_salesterritory": spark.createDataFrame(list(rows), TERRITORY)}


def test_a_failing_table_is_logged_and_the_next_goes_on(spark, rows, tmp_path):
    root = str(tmp_path)
    failed = jobs.clean_job(
        spark, raw(spark, (1, "A", "AA", "g"), (1, "B", "AA", "g"), (None, "C", None, "g")), root, "r1",
        ["clean_sales_store", "clean_sales_territory"])
    assert failed == ["clean_sales_store"]
    log = spark.read.parquet(jobs.log_path(root, "data_lineage"))
    assert rows(log, "TableSaved", "QtyWritten", "Status") == [
        ("clean_sales_store", 0, "FAIL"), ("clean_sales_territory", 1, "SUCCESS")]
    assert log.filter("Status = 'FAIL' and ErrorMsg like '%sales_store%'").count() == 1
    checks = spark.read.parquet(jobs.log_path(root, "data_quality"))
    assert rows(checks, "TableName", "CheckType", "FailedRows") == [
        ("clean_sales_territory", "DUPLICATE", 0), ("clean_sales_territory", "NULL", 0)]


def test_dimension_versions_keep_keys_over_days(spark, rows, tmp_path):
    root = str(tmp_path)
    days = [[(5, "E", "x", "g")], [(5, "E2", "x", "g"), (3, "C", "y", "g")], [(3, "C", "y", "g")]]
    for i, day in enumerate(days):
        jobs.clean_job(spark, raw(spark, *day), root, f"r{i}", ["clean_sales_territory"])
        failed = jobs.dimension_job(spark, root, f"r{i}", ("2024-01-01", "2024-01-31"))
        assert "dim_territory" not in failed and "dim_date" not in failed
    dim = jobs.read_table(spark, root, "dim_territory")
    assert rows(dim, "Territory_SK", "TerritoryID", "TerritoryName") == [
        (-1, -1, "Not registered"), (1, 5, "E2"), (2, 3, "C")]
    log = spark.read.parquet(jobs.log_path(root, "data_lineage")).filter("TableSaved = 'dim_territory'")
    assert rows(log, "RunID", "QtyWritten") == [("r0", 2), ("r1", 2), ("r2", 0)]
    assert sink.current_path(spark, jobs.table_path(root, "dim_territory")).endswith("v=00000003")
    assert set(jobs.star(spark, root)) == {"dim_territory", "dim_date"}


def test_every_dimension_source_is_declared():
    assert all(t in SPECS for _, needed in jobs.DIMENSION_SOURCES.values() for t in needed)


def test_facts_are_not_built_on_dimensions_that_failed(spark, tmp_path):
    root = str(tmp_path)
    failed = jobs.fact_job(spark, root, "r1", ["fact_sales_order_detail"], failed=["dim_product"])
    assert failed == ["fact_sales_order_detail"]
    log = spark.read.parquet(jobs.log_path(root, "data_lineage"))
    assert "dim_product failed in this run" in log.first()["ErrorMsg"]


def test_the_calendar_covers_every_stored_order(spark, tmp_path):
    root = str(tmp_path)
    assert jobs.covered_days(spark, root) == jobs.CALENDAR
    rows = spark.sql("select timestamp'2031-05-06 10:00:00' as OrderDate, cast(null as timestamp) as ShipDate")
    sink.overwrite(rows, jobs.table_path(root, "clean_sales_order_header"))
    assert jobs.covered_days(spark, root) == ("2010-01-01", "2031-05-06")


def test_the_raw_job_drains_each_table_once_with_new_columns(spark, rows, tmp_path):
    from tarnlake.plans import raw as raw_layer

    land, root = tmp_path / "land", str(tmp_path / "lake")
    first = spark.createDataFrame([(1, "a"), (None, "b")], "territoryid int, name string")
    first.write.parquet(str(land / "sales" / "salesterritory" / "salesterritory_01-01-2024.parquet"))
    spark.range(3).write.parquet(str(land / "other" / "thing" / "thing_01-01-2024.parquet"))
    assert raw_layer.raw_job(spark, str(land), root, "r1") == []
    more = spark.createDataFrame([(3, "c", "x")], "territoryid int, name string, region string")
    more.write.parquet(str(land / "sales" / "salesterritory" / "salesterritory_01-02-2024.parquet"))
    assert raw_layer.raw_job(spark, str(land), root, "r2", ["sales_salesterritory", "no_such_table"]) == ["no_such_table"]
    assert raw_layer.raw_job(spark, str(land), root, "r3", ["sales_salesterritory"]) == []
    table = raw_layer.read_raw(spark, root, "sales_salesterritory")
    assert rows(table, "name", "region", "IngestRunID") == [("a", None, "r1"), ("b", None, "r1"), ("c", "x", "r2")]
    log = spark.read.parquet(jobs.log_path(root, "data_lineage"))
    assert rows(log, "RunID", "TableSaved", "QtyRead", "QtyWritten", "Status") == [
        ("r1", "other_thing", 3, 3, "SUCCESS"), ("r1", "sales_salesterritory", 2, 2, "SUCCESS"), ("r2", "no_such_table", 0, 0, "FAIL"),
        ("r2", "sales_salesterritory", 1, 1, "SUCCESS"), ("r3", "sales_salesterritory", 0, 0, "SUCCESS")]
    checks = spark.read.parquet(jobs.log_path(root, "data_quality")).filter("CheckType = 'NULL' and ColumnName = 'territoryid'")
    assert rows(checks, "RunID", "FailedRows") == [("r1", 1), ("r2", 0)]


def test_columns_come_from_the_log_and_only_new_footers_are_opened(spark, rows, tmp_path, monkeypatch):
    from tarnlake.plans import raw as raw_layer
    from tarnlake.sources import registry

    land, root, opened = tmp_path / "land", str(tmp_path / "lake"), []
    monkeypatch.setattr(registry, "footer", lambda s, path, real=registry.footer: opened.append(path.rsplit("/", 1)[-1]) or real(s, path))

    def land_snapshot(k, schema, *values):
        spark.createDataFrame(list(values), schema).write.parquet(str(land / "sales" / "thing" / f"thing_{k}.parquet"))
        return raw_layer.raw_job(spark, str(land), root, f"r{k}")

    assert land_snapshot(1, "id int, v float", (1, 0.5)) == []
    assert land_snapshot(2, "id int, V float, extra string", (2, 1.5, "x")) == []
    assert land_snapshot(3, "id bigint, v double", (2**40, 2.5)) == []
    assert opened == ["thing_1.parquet", "thing_2.parquet", "thing_3.parquet"]
    table = raw_layer.read_raw(spark, root, "sales_thing")
    assert dict(table.dtypes)["id"] == "bigint" and dict(table.dtypes)["v"] == "double"
    assert rows(table, "id", "v", "extra", "IngestRunID") == [(1, 0.5, None, "r1"), (1099511627776, 2.5, None, "r3"), (2, 1.5, "x", "r2")]
    # A change that would lose values is refused by name; the table stays readable as it was.
    assert land_snapshot(4, "id string, v double", ("q", 1.0)) == ["sales_thing"]
    log = spark.read.parquet(jobs.log_path(root, "data_lineage")).filter("RunID = 'r4'").first()
    assert log["Status"] == "FAIL" and "column id turns from bigint to string" in log["ErrorMsg"]
    assert rows(raw_layer.read_raw(spark, root, "sales_thing"), "id") == rows(table, "id")


def test_types_grow_only_where_values_stay():
    from pyspark.sql import types as T

    from tarnlake.sources.registry import wider

    i, b, f, d, s = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()
    assert wider(i, b) == wider(b, i) == b and wider(f, d) == d and wider(s, s) == s
    assert wider(T.DecimalType(10, 2), T.DecimalType(9, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(38, 0), T.DecimalType(10, 2)) is None
    assert wider(i, d) is None and wider(i, s) is None and wider(T.DateType(), T.TimestampType()) is None


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_their_action(spark):
    """They do not stay until the driver collects its garbage; a second read of the same plan gives the same rows."""
    before = shuffle_files(spark)
    left = spark.range(5000).selectExpr("id % 700 AS k", "id AS v")
    summed = left.join(left.groupBy("k").count().hint("shuffle_merge"), "k").groupBy("k").sum("v", "count")
    first = sorted(map(tuple, summed.collect()))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, summed.collect())) == first and len(first) == 700


def test_a_load_leaves_no_copy_of_its_rows(spark, tmp_path, rows):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before, path = set(folder.glob("incoming-*")), str(tmp_path / "t")
    loads = [spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")]
    done = [ranges.upsert_ranges(x, path, ["k"], ["v"]) for x in loads]
    part = ranges.replace_within(spark.createDataFrame([(1, "e")], "k int, v string"), path, ["k"], spark.createDataFrame([(1,), (3,)], "k int"))
    assert set(folder.glob("incoming-*")) == before
    assert rows(ranges.read_ranges(spark, path, ["k"])) == [(1, "e"), (2, "c")]
    assert rows(done[1].changed, "k", "v") == [(2, "c"), (3, "d")] and rows(done[1].before) == [(2, "b")]
    assert done[1].read == 2 and rows(part.before, "k") == [(1,), (3,)]


def test_rules_of_several_tables(spark, rows):
    """The rows are those of the tables one by one, and are stored: the tables are not read again for them."""
    reads = spark.sparkContext.accumulator(0)

    def counted(k):
        reads.add(1)
        return k

    tables = {n: spark.createDataFrame([(1,), (1,), (None,)], "k int").select(F.udf(counted, "int")("k").alias("k")) for n in ("a", "b")}
    book = {n: Rule(("k",), ("k",)) for n in tables}
    kw = dict(layer="SILVER", run_id="r", process="p")
    found = apply_rules_to_all(tables, book, **kw)
    seen = reads.value
    assert seen and rows(found, "TableName", "CheckType", "TotalRows", "FailedRows") == [
        (n, c, 3, 1) for n in ("a", "b") for c in ("DUPLICATE", "NULL")]
    assert reads.value == seen
