from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.functions.scalars import (
    blank,
    customer_type,
    date_key,
    days_since,
    direction,
    flag,
    growth,
    margin,
    profit_status,
    ratio,
    repaired_category,
    short_name,
)
from tarnlake.operators import audit, quality, rules
from tarnlake.operators.cleaning import CleanSpec, Part


def one(spark, expr, **values):
    cols = [F.lit(v).alias(n) for n, v in values.items()]
    return spark.range(1).select(*cols).select(expr.alias("x")).first().x


@pytest.mark.parametrize(("cur", "prev", "want", "strict"), [
    (15.0, 10.0, 0.5, 0.5), (5.0, 10.0, -0.5, -0.5), (5.0, 0.0, 0.0, 0.0), (5.0, None, 0.0, None)])
def test_growth_after_missing_and_zero_periods(spark, cur, prev, want, strict):
    values = {"c": cur, "p": prev}
    df = spark.createDataFrame([(cur, prev)], "c double, p double")
    assert df.select(growth("c", "p")).first()[0] == want
    assert df.select(growth("c", "p", on_null=None)).first()[0] == strict
    assert values


def test_ratio_margin_and_status(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 15.0), (10.0, 4.0)], "r double, c double")
    got = df.select(margin("r", "c"), profit_status(F.col("r") - F.col("c")), ratio("c", "r", None)).collect()
    assert [tuple(g) for g in got] == [
        (0.0, "Not Profitable", None), (-0.5, "Not Profitable", 1.5), (0.6, "Profitable", 0.4)]


@pytest.mark.parametrize(("name", "want"), [
    ("blue bolt-788", "B788-788"), ("Road-150 Red, 62", "R150-62"), ("helmet", "H-"), ("v2 wheel", "V2-")])
def test_short_product_names(spark, name, want):
    assert one(spark, short_name("n"), n=name) == want


def test_flags_and_directions(spark):
    df = spark.createDataFrame([(0.2,), (-0.2,), (0.1,), (None,)], "g double")
    got = [tuple(r) for r in df.select(direction("g"), flag(F.col("g") > 0.1)).collect()]
    assert got == [(1, 1), (-1, 0), (0, 0), (0, 0)]


def test_date_key_and_days_since(spark):
    df = spark.sql("select date'2024-03-09' a, cast(null as date) b")
    assert tuple(df.select(date_key("a"), days_since("a", "b"), days_since("a", "a")).first()) == (20240309, 999, 0)


def test_customer_type_without_ids(spark):
    df = spark.createDataFrame([(None, None)], "p int, s int")
    assert df.select(customer_type("p", "s")).first()[0] == "NOT REGISTERED"


def test_repaired_categories(spark):
    nr = "Not registered"
    df = spark.createDataFrame([(nr, nr), (nr, "Caps"), ("Bikes", None)], "c string, s string")
    got = [tuple(r) for r in df.select(*[repaired_category("c", "s", x) for x in ("c", "s")]).collect()]
    assert got == [("Miscellaneous", "Miscellaneous"), (nr, "Caps"), ("Bikes", "Miscellaneous")]


EDGE = [(1, "a", 1.0), (1, "", float("nan")), (None, "   ", 2.0), (None, None, None)]


def test_blank_takes_null_and_spaces_but_not_nan(spark, rows):
    df = spark.createDataFrame(EDGE, "i int, s string, d double")
    got = {r[0]: r[3] for r in rows(quality.null_checks(df, ["i", "s", "d"]))}
    assert got == {"i": 2, "s": 3, "d": 1}
    assert df.filter(blank("d")).count() == 1


def test_duplicates_count_null_as_one_value(spark, rows):
    df = spark.createDataFrame(EDGE, "i int, s string, d double")
    got = {r[0]: (r[2], r[3]) for r in rows(quality.duplicate_checks(df, ["i", "s", ("i", "s")]))}
    assert got == {"i": (4, 2), "s": (4, 0), "i, s": (4, 0)}


def test_null_checks_are_one_pass(spark):
    df = spark.createDataFrame(EDGE, "i int, s string, d double")
    plan = quality.null_checks(df, ["i", "s", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_quality_of_empty_input_is_empty(spark):
    df = spark.createDataFrame([], "i int")
    out = quality.quality(df, ["i"], ["i"], run_id="r", process="p", layer="SILVER", table="t")
    assert out.count() == 0


def test_rules_skip_unknown_tables_and_missing_columns(spark, rows):
    df = spark.createDataFrame([(1, " ")], "id int, FileSource string")
    book = {"Sales_X": rules.Rule(("id", "nope"), ("id", ("id", "nope")))}
    kw = dict(run_id="r", process="p")
    bronze = rules.apply_rules(df, book, "sales_x", layer="BRONZE", **kw)
    assert rows(bronze, "ColumnName", "CheckType", "Status") == [
        ("FileSource", "NULL", "FAIL"), ("id", "DUPLICATE", "SUCCESS"), ("id", "NULL", "SUCCESS")]
    assert rules.apply_rules(df, book, "sales_x", layer="SILVER", **kw).count() == 0
    assert rules.apply_rules(df, book, "Sales_X", layer="SILVER", **kw).count() == 2


def test_rules_from_declarations_and_from_rows(spark):
    spec = CleanSpec("t", (Part("x", {"a": "b.a"}),), ("a", "b"), ("a", "b"))
    assert rules.rules_from_specs([spec])["t"] == rules.Rule(("a", "b"), (("a", "b"),))
    df = spark.createDataFrame(
        [("t", "a", "NULL"), ("t", "a", "DUPLICATE"), ("u", "z", "NULL")],
        "table_name string, column_name string, check_type string")
    assert rules.rules_from_table(df) == {"t": rules.Rule(("a",), ("a",)), "u": rules.Rule(("z",), ())}


def test_lineage_row_shortens_and_cleans_errors(spark):
    r = audit.lineage_row(
        spark, run_id="1", process="p", layer="L", table="t", start=datetime(2024, 1, 1), status="FAIL",
        error=ValueError("it's " + "x" * 900)).first()
    assert len(r.ErrorMsg) == 500 and r.ErrorMsg.startswith("it s x")


def test_run_state_of_started_and_finished_runs(spark, rows):
    log = audit.run_started(spark, "a", "main", "daily", "no time").unionByName(
        audit.run_started(spark, "b", "main", "daily", "2024-01-01 00:01:00")
    ).unionByName(audit.run_finished(spark, "b", "FAIL", "broke"))
    state = audit.run_state(log)
    assert rows(state, "ADFRunID", "PipelineName", "Status", "ErrorMessage") == [
        ("a", "main", "STARTED", None), ("b", "main", "FAIL", "broke")]
    assert state.filter("TriggerTime is null or StartTime is null").count() == 0


def test_derived_rule_books():
    from tarnlake.plans.rulebooks import bronze_rules, silver_rules

    bronze, silver = bronze_rules(), silver_rules()
    assert bronze["production_product"] == rules.Rule(("productid",), ("productid",))
    assert bronze["person_countryregion"] == rules.Rule(("countryregioncode",), ("countryregioncode",))
    assert bronze["csv_salesorderdetail"] == rules.Rule(("_c1",), ("_c1",))
    assert bronze["purchasing_purchaseorderdetail"].check_dup == (("purchaseorderid", "purchaseorderdetailid"),)
    assert silver["dim_customer"].check_dup == ("Customer_SK", "CustomerID")
    assert silver["fact_purchases"] == rules.Rule(("PurchaseID",), ("PurchaseID",))
    assert len(silver) == 29 + 6 + 1 + 3


def test_duplicates_of_many_columns_in_one_pass(spark, rows):
    from tarnlake.operators.quality import duplicate_checks

    df = spark.createDataFrame(
        [(1, None, "a", 0.0), (2, "a", None, -0.0), (3, None, "a", float("nan")), (4, None, None, float("nan")), (4, None, None, None)],
        "k int, x string, y string, d double")
    out = duplicate_checks(df, ["k", "x", ("x", "y"), ("y", "x"), "d"])
    assert rows(out, "ColumnName", "TotalRows", "FailedRows") == [("d", 5, 2), ("k", 5, 1), ("x", 5, 3), ("x, y", 5, 2), ("y, x", 5, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan") <= 1 + plan.count("ReusedExchange")
    assert duplicate_checks(df.limit(0), ["k", "x"]).isEmpty() and duplicate_checks(df, []).isEmpty()


def test_duplicate_checks_group_by_plain_columns(spark):
    from tarnlake.operators.quality import duplicate_checks

    out = duplicate_checks(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "c")], "x int, y string"), ["x", ("x", "y")])
    assert {(r.ColumnName, r.TotalRows, r.FailedRows) for r in out.collect()} == {("x", 4, 2), ("x, y", 4, 1)}
    # Sums keyed by a struct are kept out of the fast hash map.
    assert "Aggregate [i#" in out._jdf.queryExecution().optimizedPlan().toString()


def test_quality_reads_the_table_once(spark, tmp_path):
    """Blank values and repeated keys are found in one pass, also with several keys, nulls and no rows."""
    from tarnlake.operators import quality

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (1, " "), (None, None), (2, "a"), (None, None)], "i int, s string").write.parquet(path)
    df = spark.read.parquet(path)

    def told(rows):
        out = quality.quality(rows, ["i", "s"], ["i", ("i", "s")], run_id="r", process="p", layer="SILVER", table="t")
        return out, {(r.ColumnName, r.CheckType): (r.TotalRows, r.FailedRows, r.Status) for r in out.collect()}

    out, found = told(df)
    assert found == {
        ("i", "NULL"): (5, 2, "FAIL"), ("s", "NULL"): (5, 3, "FAIL"), ("i", "DUPLICATE"): (5, 2, "FAIL"), ("i, s", "DUPLICATE"): (5, 1, "FAIL")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert told(df.limit(0))[1] == {}


def test_cleaned_rows_are_not_shuffled_again_for_their_key(spark):
    """A cleaned table lies by its key, so its checks add only the shuffle of the last sum."""
    from tarnlake.operators import quality
    from tarnlake.operators.dedup import dedup

    df = dedup(spark.range(50).selectExpr("id % 7 AS i", "id % 2 AS j", "id"), ["i", "j"])
    plan = quality.quality(df, ["i"], [("i", "j")], run_id="r", process="p", layer="SILVER", table="t")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(i") == 1
    assert "xxhash64" not in plan._jdf.queryExecution().executedPlan().toString()
    assert [(r.TotalRows, r.FailedRows) for r in plan.collect()] == [(14, 0), (14, 0)]
