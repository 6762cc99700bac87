from datetime import date

from pyspark.sql import functions as F

from tarnlake.operators.cleaning import CleanSpec, Lookup, Part, clean
from tarnlake.operators.dedup import dedup
from tarnlake.plans.clean_tables import ORDER_DETAIL, ORDER_HEADER, SPECS, clean_table


def test_first_row_per_key_nulls_last_and_ties_by_other_columns(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 5, "c"), (1, 5, "b"), (2, None, "z"), (2, None, "y")],
        "k int, o int, v string",
    )
    assert rows(dedup(df, ["k"], ["o desc"])) == [(1, 5, "b"), (2, None, "y")]
    assert rows(dedup(df, ["k"], ["o"])) == [(1, None, "a"), (2, None, "y")]


def test_survivor_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("o"), "id")
    want = rows(dedup(df, ["k"], ["o desc"]))
    assert rows(dedup(df.repartition(13, "id"), ["k"], ["o desc"])) == want
    assert [(r[0], r[1]) for r in want] == [(k, 2) for k in range(7)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = dedup(df.repartition(4), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning(k")


def test_recipe_drops_null_keys_and_joins_lookups(spark, rows):
    tables = {
        "t": spark.createDataFrame([(1, 10), (None, 10), (1, 20), (2, 99)], "id int, ref int"),
        "l": spark.createDataFrame([(10, "ten"), (20, "twenty")], "ref int, name string"),
    }
    spec = CleanSpec(
        "x", (Part("t", {"Id": "b.id", "Name": "l.name"}, (Lookup("l", "l", "b.ref = l.ref"),)),),
        ("Id",), ("Id",), ("Name desc",))
    assert rows(clean(tables, spec)) == [(1, "twenty"), (2, None)]


def test_empty_input_gives_empty_output(spark):
    tables = {"sales_customer": spark.createDataFrame([], "customerid int, personid int, storeid int, territoryid int")}
    assert clean_table("clean_sales_customer", tables).count() == 0


def _texts(n, **given):
    return tuple(given.get(f"_c{i}") for i in range(n))


def test_history_text_is_typed_and_bad_text_is_null(spark):
    n = len(ORDER_HEADER)
    schema = ", ".join(f"_c{i} string" for i in range(n))
    raw = spark.createDataFrame(
        [_texts(n, _c0="7", _c1="x", _c2="2012-13-40", _c6="maybe", _c19="12.34567"), _texts(n, _c0="seven")], schema)
    live = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in ORDER_HEADER.items()))
    out = clean_table("clean_sales_order_header", {"sales_salesorderheader": live, "csv_salesorderheader": raw}).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.SalesOrderID, r.RevisionNumber, r.OrderDate, r.OnlineOrderFlag, str(r.SubTotal)) == (7, None, None, None, "12.3457")


def test_history_lines_union_live_lines_once_per_id(spark, rows):
    schema = ", ".join(f"{c} {t}" for c, t in ORDER_DETAIL.items())
    live = spark.createDataFrame([], schema)
    raw = spark.createDataFrame(
        [("1", "5", "T", "2", "9", "1", "1.5", "0", "3")] * 2 + [("1", None, "T", "2", "9", "1", "1.5", "0", "3")],
        ", ".join(f"_c{i} string" for i in range(9)))
    out = clean_table("clean_sales_order_detail", {"sales_salesorderdetail": live, "csv_salesorderdetail": raw})
    assert rows(out, "SalesOrderID", "SalesOrderDetailID", "OrderQty") == [(1, 5, 2)]


def test_closed_history_row_wins_over_open_one(spark, rows):
    t = {"sales_salesterritoryhistory": spark.createDataFrame(
        [(1, 2, date(2020, 1, 1), None), (1, 2, date(2020, 1, 1), date(2020, 2, 1))],
        "businessentityid int, territoryid int, startdate date, enddate date")}
    assert rows(clean_table("clean_sales_territory_history", t), "enddate") == [(date(2020, 2, 1),)]


def test_all_tables_are_declared_once():
    assert len(SPECS) == 29
    assert all(s.required for s in SPECS.values())
