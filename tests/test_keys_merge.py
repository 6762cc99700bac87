import pytest
from pyspark.sql import functions as F

from tarnlake.operators.keys import assert_key, assign_keys, key_report, number_rows, with_unknown
from tarnlake.operators.lookup import lookup_sk
from tarnlake.operators.merge import ACTION, duplicate_keys, merge_counts, reject_duplicates, scd1_merge
from tarnlake.plans import dims


def test_numbers_follow_the_order_over_many_partitions(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).cast("string").alias("k"))
    got = number_rows(df.repartition(9), ["k"], "n", start=11).orderBy("k").collect()
    assert [r.n for r in got] == list(range(11, 511))


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0).select("id"), ["id"], "n").count() == 0


def test_given_keys_are_kept_and_new_ones_follow(spark, rows):
    target = spark.createDataFrame([(3, "m"), (1, "z"), (-1, "?")], "sk long, k string")
    new = spark.createDataFrame([("a",), ("z",), ("q",)], "k string")
    assert rows(assign_keys(new, target, "sk", ["k"]), "k", "sk") == [("a", 4), ("q", 5)]


def test_unknown_member_is_added_once(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.5)], "sk long, name string, v double")
    once = with_unknown(df, "sk", {"name": "none"})
    assert rows(with_unknown(once, "sk", {"name": "none"})) == [(-1, "none", None), (1, "a", 2.5)]


def test_key_report_and_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 3)], "a int, b int")
    r = key_report(df, ["a", "b"]).first()
    assert (r.total_rows, r.null_rows, r.duplicate_keys) == (4, 1, 1)
    with pytest.raises(ValueError, match="key"):
        assert_key(df, ["a", "b"])
    assert assert_key(df.filter("a = 2"), ["a", "b"]).count() == 1


def test_key_report_of_nothing(spark):
    r = key_report(spark.range(0), ["id"]).first()
    assert (r.total_rows, r.null_rows, r.duplicate_keys) == (0, 0, 0)


TARGET = [(1, "same", 10), (2, "old", 20), (3, "gone", 30), (4, None, 40), (5, "full", 50)]
SOURCE = [(1, "same"), (2, "new"), (4, "filled"), (5, None), (9, "fresh"), (7, "other")]
MERGED = [
    (1, "same", "keep"), (2, "new", "update"), (3, "gone", "keep"), (4, "filled", "update"),
    (5, None, "update"), (7, "other", "insert"), (9, "fresh", "insert"),
]


def _frames(spark):
    return (
        spark.createDataFrame(TARGET, "id int, v string, sk long"),
        spark.createDataFrame(SOURCE, "id int, v string"),
    )


def test_merge_actions_without_surrogate_key(spark, rows):
    target, source = _frames(spark)
    merged = scd1_merge(target.drop("sk"), source, ["id"], ["v"])
    assert rows(merged, "id", "v", ACTION) == MERGED
    counts = merge_counts(merged).first()
    assert (counts.inserted, counts.updated, counts.kept) == (2, 3, 2)


def test_merge_keeps_surrogate_keys(spark, rows):
    target, source = _frames(spark)
    merged = scd1_merge(target, source, ["id"], ["v"], sk="sk")
    assert rows(merged, "id", "v", ACTION) == MERGED
    assert rows(merged, "id", "sk") == [(1, 10), (2, 20), (3, 30), (4, 40), (5, 50), (7, 51), (9, 52)]


@pytest.mark.parametrize("sk", [None, "sk"])
def test_merging_twice_changes_nothing(spark, rows, sk):
    target, source = _frames(spark)
    once = scd1_merge(target if sk else target.drop("sk"), source, ["id"], ["v"], sk=sk).drop(ACTION)
    again = scd1_merge(once, source, ["id"], ["v"], sk=sk)
    assert rows(again.drop(ACTION)) == rows(once)
    assert {r[ACTION] for r in again.collect()} == {"keep"}


@pytest.mark.parametrize("sk", [None, "sk"])
def test_duplicate_source_key_fails_loudly(spark, sk):
    target, source = _frames(spark)
    doubled = source.union(spark.createDataFrame([(9, "again")], "id int, v string"))
    assert duplicate_keys(doubled, ["id"]).first().asDict() == {"id": 9, "copies": 2}
    with pytest.raises(ValueError, match="several rows"):
        reject_duplicates(doubled, ["id"])
    with pytest.raises(Exception, match="several rows"):
        scd1_merge(target if sk else target.drop("sk"), doubled, ["id"], ["v"], sk=sk).collect()


def test_source_check_adds_no_shuffle(spark):
    target, source = _frames(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        def shuffles(check):
            merged = scd1_merge(target.drop("sk"), source, ["id"], ["v"], check_source=check)
            return merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

        assert shuffles(True) == shuffles(False) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_gives_unknown_for_missing_and_null(spark, rows):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, k int")
    dim = spark.createDataFrame([(100, 5), (101, 7)], "sk long, k int")
    assert rows(lookup_sk(fact, dim, "k", "k", "sk", "dim_sk"), "id", "dim_sk") == [(1, 100), (2, -1), (3, -1)]


def test_lookup_with_a_hot_key_keeps_every_row(spark):
    fact = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dim = spark.range(9000).select((F.col("id") + 1).alias("sk"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = lookup_sk(fact, dim, "k", "k", "sk", "dim_sk")
        assert out.count() == 9000
        assert out.filter("dim_sk <> k + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_customer_type_branches(spark, rows):
    customers = spark.createDataFrame(
        [(1, 10, 20), (2, None, 20), (3, None, None), (4, 11, None)],
        "CustomerID int, PersonID int, StoreID int")
    persons = spark.createDataFrame([(10, "Ann", "Lee")], "PersonID int, FirstName string, LastName string")
    stores = spark.createDataFrame([(20, "Shop")], "StoreID int, StoreName string")
    out = dims.customer_source(customers, persons, stores)
    assert rows(out, "CustomerID", "CustomerType", "PersonName", "StoreName") == [
        (1, "PERSON", "Ann Lee", "Shop"), (2, "STORE", "Not registered", "Shop"),
        (3, "NOT REGISTERED", "Not registered", "Not registered"), (4, "PERSON", "", "Not registered")]


def test_dimension_loaded_twice_is_stable(spark, rows):
    source = spark.createDataFrame(
        [(5, "E", "g", "X"), (3, "C", "g", "Y")],
        "TerritoryID int, TerritoryName string, TerritoryGroup string, CountryRegionCode string")
    first = dims.load_dimension("dim_territory", source, None).drop(ACTION)
    assert rows(first, "Territory_SK", "TerritoryID") == [(-1, -1), (1, 3), (2, 5)]
    second = dims.load_dimension("dim_territory", source.union(source.limit(0)), first)
    assert rows(second.drop(ACTION)) == rows(first)


def test_calendar_has_every_day(spark):
    cal = dims.dim_date(spark, "2010-01-01", "2025-12-31")
    assert cal.count() == 5844
    r = cal.filter("DateKey = 20240229").first()
    assert (r.DayNameOfWeek, r.MonthName, r.CalendarQuarter, r.DayNumberOfWeek, r.IsWeekend) == ("Thursday", "February", 1, 5, 0)


def test_upsert_touches_only_changed_buckets(spark, rows, tmp_path):
    from pathlib import Path

    from tarnlake.sinks.buckets import bucket_column, read_buckets, upsert_buckets

    path = str(tmp_path / "fact")

    def day(*values):
        return spark.createDataFrame(list(values), "k long, v string, n int")

    first = upsert_buckets(day(*[(i, f"v{i}", i) for i in range(200)]), path, ["k"], ["v", "n"], buckets=16)
    assert {r.merge_action for r in first.collect()} == {"insert"}
    files = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    assert len({f.parent for f in files}) == 16
    merged = upsert_buckets(day((7, "new", 7), (1000, "x", 1), (8, "v8", 8)), path, ["k"], ["v", "n"], buckets=99)
    assert {r.k: r.merge_action for r in merged.collect() if r.k in (7, 8, 1000)} == {7: "update", 8: "keep", 1000: "insert"}
    stored = read_buckets(spark, path)
    assert stored.count() == 201 and rows(stored.filter("k in (7, 8, 1000)")) == [(1000, "x", 1), (7, "new", 7), (8, "v8", 8)]
    table = spark.read.parquet(path)
    changed = {r[0] for r in table.filter("k in (7, 1000)").select(bucket_column(table)).collect()}
    now = set(Path(path).rglob("*.parquet"))
    gone = {f.parent.name for f in files if f not in now}
    assert gone == {f"{bucket_column(table)}={b}" for b in changed}
    assert all(f.stat().st_mtime_ns == files[f] for f in now & set(files))
    plan = table.filter(table[bucket_column(table)].isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert upsert_buckets(day((7, "new", 7)), path, ["k"], ["v", "n"]).filter("merge_action <> 'keep'").count() == 0


def test_upsert_refuses_two_rows_for_a_key(spark, tmp_path):
    from tarnlake.sinks.buckets import upsert_buckets

    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        upsert_buckets(twice, str(tmp_path / "f"), ["k"], ["v"])


def test_lookup_takes_the_newest_of_several_members(spark, rows):
    from tarnlake.operators.lookup import lookup_sk

    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, c int")
    dim = spark.createDataFrame([(10, 5), (10, 8), (12, 9)], "c int, sk long")
    assert rows(lookup_sk(fact, dim, "c", "c", "sk", "found"), "id", "found") == [(1, 8), (2, -1), (3, -1)]


def test_a_batch_of_new_keys_leaves_every_stored_file_as_it_is(spark, rows, tmp_path):
    from pathlib import Path

    from tarnlake.sinks.ranges import compact_ranges, file_list, read_ranges, remove_unlisted, touched_files, upsert_ranges

    path = str(tmp_path / "fact")

    def day(low, high, text="v"):
        return spark.range(low, high).selectExpr("id AS k", f"concat('{text}', id) AS v", "CAST(id % 7 AS INT) AS n")

    first = upsert_ranges(day(0, 40000).repartition(4), path, ["k"], ["v", "n"])
    assert first.read == 40000 and first.changed.count() == 40000
    assert {r[0] for r in first.changed.select("merge_action").distinct().collect()} == {"insert"}

    def files():
        return {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path, "files").rglob("part-*.parquet")}

    old = files()
    # New ids, as every day brings: no stored file is read, none is replaced.
    assert touched_files(file_list(spark, path), day(40000, 41000), "k").isEmpty()
    assert upsert_ranges(day(40000, 41000), path, ["k"], ["v", "n"]).changed.count() == 1000
    now = files()
    assert old.items() <= now.items() and len(now) > len(old)
    # The scan opens what the list names and joins nothing.
    table = read_ranges(spark, path, ["k"])
    named = {r.file for r in file_list(spark, path).collect()}
    assert {"/".join(f.split("/")[-2:]) for f in table.inputFiles()} == named
    assert "Join" not in table._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 41000

    # Changed values become overrides; an equal row changes nothing.
    mixed = day(5, 8, "new").unionByName(day(9, 10)).unionByName(day(90000, 90001))
    done = upsert_ranges(mixed, path, ["k"], ["v", "n"])
    assert done.read == 5 and sorted((r.k, r.merge_action) for r in done.changed.collect()) == [
        (5, "update"), (6, "update"), (7, "update"), (90000, "insert")]
    assert now.items() <= files().items()
    upsert_ranges(day(6, 7, "newer"), path, ["k"], ["v", "n"])
    before = rows(read_ranges(spark, path, ["k"]))
    assert len(before) == 41001 and rows(read_ranges(spark, path, ["k"]).filter("k IN (5, 6, 8, 90000)")) == [
        (5, "new5", 5), (6, "newer6", 6), (8, "v8", 1), (90000, "v90000", 1)]
    assert upsert_ranges(mixed.filter("k <> 6"), path, ["k"], ["v", "n"]).changed.isEmpty()

    # Folding rewrites what the overrides touch and gives the same rows.
    kept = files()
    assert compact_ranges(spark, path, ["k"], small_rows=0) >= 3
    assert rows(read_ranges(spark, path, ["k"])) == before and kept.items() <= files().items()
    assert file_list(spark, path).filter("overrides").isEmpty()
    assert remove_unlisted(spark, path) >= 3 and rows(read_ranges(spark, path, ["k"])) == before
    assert compact_ranges(spark, path, ["k"], small_rows=0) == 0


def test_files_are_found_by_block_where_ranges_overlap(spark, tmp_path):
    from tarnlake.sinks.ranges import file_list, touched_files, upsert_ranges

    path = str(tmp_path / "fact")
    wide = spark.createDataFrame([(1, "a"), (10**9, "b")], "k long, v string")
    upsert_ranges(wide, path, ["k"], ["v"])
    listed = file_list(spark, path)
    inside = spark.createDataFrame([(5 * 10**8, "c")], "k long, v string")
    # Inside the range of a file that spans both, but in no block of it.
    assert touched_files(listed, inside, "k").isEmpty()
    assert touched_files(listed, inside.withColumn("k", inside["k"] * 2), "k").count() == 1
    # Files without blocks count by range alone.
    from pyspark.sql import functions as F
    whole = listed.withColumn("blocks", F.lit(None).cast("array<bigint>")).withColumns({"low": F.lit(1).cast("long"), "high": F.lit(10**9).cast("long")})
    assert touched_files(whole, inside, "k").count() == whole.count()


def test_ranges_of_odd_tables(spark, rows, tmp_path):
    from tarnlake.sinks.ranges import exists, read_ranges, upsert_ranges

    schema, keys = "a string, b date, v double", ["a", "b"]

    def frame(*values):
        return spark.createDataFrame([(a, __import__("datetime").date(2024, 1, d), v) for a, d, v in values], schema)

    path = str(tmp_path / "empty")
    assert not exists(spark, path)
    assert upsert_ranges(frame(), path, keys, ["v"]).read == 0
    assert exists(spark, path) and rows(read_ranges(spark, path, keys)) == []
    assert upsert_ranges(frame(("x", 1, None), ("x", 2, 1.0), ("y", 1, 2.0)), path, keys, ["v"]).changed.count() == 3
    again = upsert_ranges(frame(("x", 1, None), ("x", 2, None), ("z", 1, 5.0)), path, keys, ["v"])
    assert sorted((r.a, r.b.day, r.merge_action) for r in again.changed.collect()) == [("x", 2, "update"), ("z", 1, "insert")]
    assert [(r.a, r.b.day, r.v) for r in read_ranges(spark, path, keys).orderBy("a", "b").collect()] == [
        ("x", 1, None), ("x", 2, None), ("y", 1, 2.0), ("z", 1, 5.0)]
    assert upsert_ranges(frame(), path, keys, ["v"]).changed.isEmpty()
    for bad in (frame(("q", 1, 1.0), ("q", 1, 2.0)),):
        for place in (path, str(tmp_path / "new")):
            with pytest.raises(Exception, match="several rows for one key"):
                upsert_ranges(bad, place, keys, ["v"])
    assert not exists(spark, str(tmp_path / "new")) and read_ranges(spark, path, keys).count() == 4
    with pytest.raises(ValueError, match="columns differ"):
        upsert_ranges(frame(("q", 1, 1.0)).withColumnRenamed("v", "w"), path, keys, ["w"])


def test_blocks_of_keys_are_reserved_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tarnlake.operators.ledger import assign_from_ledger, reserve

    path = str(tmp_path / "ledger")
    with ThreadPoolExecutor(4) as pool:
        taken = [n for some in pool.map(lambda k: reserve(spark, path, k), (3, 5, 2, 4, 1)) for n in some]
    assert len(taken) == 15 == len(set(taken)) and reserve(spark, path, 0) == []
    new = spark.range(2500).withColumnRenamed("id", "nk").repartition(7)
    first = assign_from_ledger(new, None, "sk", ["nk"], path, block=1000)
    keys = sorted(r.sk for r in first.collect())
    assert len(set(keys)) == 2500 and min(keys) > 15 * 1000 and first.columns == ["nk", "sk"]
    more = assign_from_ledger(spark.range(2490, 2600).withColumnRenamed("id", "nk"), first, "sk", ["nk"], path, block=1000)
    assert {r.nk for r in more.collect()} == set(range(2500, 2600)) and not {r.sk for r in more.collect()} & set(keys)
    assert assign_from_ledger(new, first, "sk", ["nk"], path).isEmpty()


def test_many_blocks_take_few_files(spark, tmp_path):
    """A load of thousands of blocks reserves them in stretches, side by side with others, and keys stay unique."""
    import os
    from concurrent.futures import ThreadPoolExecutor

    from tarnlake.operators.ledger import assign_from_ledger, reserve

    path = str(tmp_path / "ledger")
    with ThreadPoolExecutor(3) as pool:
        taken = [n for some in pool.map(lambda k: reserve(spark, path, k), (5000, 4097, 130)) for n in some]
    assert len(taken) == len(set(taken)) == 5000 + 4097 + 130
    before = len([f for f in os.listdir(path) if not f.startswith(".")])
    assert before < 100
    new = spark.range(9000).withColumnRenamed("id", "nk").repartition(5)
    first = assign_from_ledger(new, None, "sk", ["nk"], path, block=2).cache()
    keys = [r.sk for r in first.collect()]
    assert len(keys) == len(set(keys)) == 9000 and min(keys) > 0
    assert not {(k - 1) // 2 for k in keys} & set(taken) and len([f for f in os.listdir(path) if not f.startswith(".")]) < before + 100
    more = assign_from_ledger(spark.range(8990, 9300).withColumnRenamed("id", "nk"), first, "sk", ["nk"], path, block=2).collect()
    assert {r.nk for r in more} == set(range(9000, 9300)) and not {r.sk for r in more} & set(keys)


def test_stored_sources_are_not_stored_again(spark, tmp_path, monkeypatch):
    """A source read from stored files is merged as it stands, with the same counts, changes and rows."""
    from tarnlake.sinks import ranges

    rows = ranges.staged(spark.createDataFrame([(k, f"v{k % 3}") for k in range(50)], "k long, v string"))
    path = str(tmp_path / "t")
    monkeypatch.setattr(ranges, "_staged", lambda source: (_ for _ in ()).throw(AssertionError("stored twice")))
    assert ranges.upsert_ranges(rows.filter("k < 20").withColumn("v", F.lit("v0")), path, ["k"], ["v"], staged=True).read == 20
    done = ranges.upsert_ranges(rows, path, ["k"], ["v"], staged=True)
    found = {(r.k, r.merge_action) for r in done.changed.collect()}
    assert done.read == 50 and found == {(k, "update") for k in range(20) if k % 3} | {(k, "insert") for k in range(20, 50)}
    assert sorted(ranges.read_ranges(spark, path, ["k"]).collect()) == sorted(rows.collect())
