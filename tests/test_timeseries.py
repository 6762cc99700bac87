from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.operators.quantiles import exact_quantiles
from tarnlake.operators.timeseries import (
    Trailing,
    dense_series,
    dense_trailing,
    densify,
    lagged,
    last_event,
    pack_series,
    rank_places,
    rank_within,
    series_stretches,
    stretch_rows,
    trailing,
    trailing_days,
)

DAY0 = date(2020, 1, 1)


def series(spark, cells):
    """cells: {entity: {day offset: quantity}}"""
    data = [(e, DAY0 + timedelta(d), q) for e, days in cells.items() for d, q in days.items()]
    return spark.createDataFrame(data, "e int, d date, q long")


def brute(cells, n, lag):
    """Dense rows with trailing sum, mean, earlier sum and lag, worked out by loops."""
    out = []
    for e, days in cells.items():
        first, last = min(days), max(days)
        value = {d: days.get(d, 0) for d in range(first, last + 1)}

        def total(d):
            return sum(value.get(x, 0) for x in range(d - n + 1, d + 1)) if d >= first else None

        for d in value:
            seen = min(n, d - first + 1)
            positive = [x for x in range(first, d + 1) if value[x] > 0]
            out.append((
                e, DAY0 + timedelta(d), value[d], total(d), round(total(d) / seen, 9), total(d - lag),
                value.get(d - lag, 0), DAY0 + timedelta(positive[-1]) if positive else None))
    return sorted(out, key=repr)


def dense_rows(spark, cells, n, lag):
    days = dense_series(series(spark, cells), ["e"], "d", ["q"], events={"sold": F.col("q") > 0})
    out = trailing(days, ["e"], "d", {"s": ("q", n)}, {"a": ("q", n)}, {"p": ("q", n, lag)}, {"l": ("q", lag)})
    got = out.select("e", "d", "q", "s", F.round("a", 9), "p", "l", "sold").collect()
    return sorted((tuple(r) for r in got), key=repr)


CELLS = {
    1: {0: 5},  # one date only
    2: {0: 1, 1: 2, 50: 3},  # gap longer than the window
    3: {d: d % 4 for d in range(0, 40, 3)},
    4: {0: 0, 2: 0, 5: 7},  # zero quantities are days with data
}


@pytest.mark.parametrize(("n", "lag"), [(1, 1), (7, 7), (30, 30), (30, 3), (365, 90)])
def test_dense_windows_match_loops(spark, n, lag):
    assert dense_rows(spark, CELLS, n, lag) == brute(CELLS, n, lag)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.integers(0, 3), st.dictionaries(st.integers(0, 60), st.integers(0, 9), min_size=1, max_size=8),
        min_size=1, max_size=3),
    st.integers(1, 40), st.integers(1, 40))
def test_dense_windows_match_loops_on_random_series(spark, cells, n, lag):
    assert dense_rows(spark, cells, n, lag) == brute(cells, n, lag)


def test_running_total_form_equals_range_frame(spark):
    days = densify(series(spark, CELLS), ["e"], "d", ["q"])
    both = trailing_days(trailing(days, ["e"], "d", {"s": ("q", 30)}), ["e"], "d", "q", 30, "r")
    assert both.filter("s <> r").count() == 0


def test_densify_extends_to_upper(spark, rows):
    out = densify(series(spark, {1: {0: 4}}), ["e"], "d", ["q"], upper=F.lit(DAY0 + timedelta(2)))
    assert rows(out, "d", "q") == [(DAY0, 4), (DAY0 + timedelta(1), 0), (DAY0 + timedelta(2), 0)]


def test_densify_upper_before_last_row_changes_nothing(spark, rows):
    out = densify(series(spark, {1: {0: 4, 2: 5}}), ["e"], "d", ["q"], upper=F.lit(DAY0))
    assert [q for _, q in rows(out, "d", "q")] == [4, 0, 5]


def test_months_over_a_year_end(spark, rows):
    df = spark.createDataFrame([(1, date(2020, 11, 1), 2), (1, date(2021, 2, 1), 3)], "e int, d date, q long")
    out = trailing(
        dense_series(df, ["e"], "d", ["q"], step="month"), ["e"], "d", {"s": ("q", 3)}, {"a": ("q", 3)})
    assert rows(out, "d", "q", "s", "a") == [
        (date(2020, 11, 1), 2, 2, 2.0), (date(2020, 12, 1), 0, 2, 1.0), (date(2021, 1, 1), 0, 2, 2 / 3),
        (date(2021, 2, 1), 3, 3, 1.0)]


def test_empty_series(spark):
    empty = series(spark, {1: {0: 1}}).limit(0)
    assert trailing(dense_series(empty, ["e"], "d", ["q"]), ["e"], "d", {"s": ("q", 7)}).count() == 0


def test_lag_and_last_event_on_sparse_rows(spark, rows):
    df = series(spark, {1: {0: 1, 5: 9, 6: 2}})
    out = last_event(lagged(df, ["e"], "d", {"l": ("q", 2)}, 0), ["e"], "d", F.col("q") > 5, "big")
    assert rows(out, "q", "l", "big") == [(1, 0, None), (2, 1, DAY0 + timedelta(5)), (9, 0, DAY0 + timedelta(5))]


def test_rank_shares_places_and_skips(spark, rows):
    df = spark.createDataFrame([(1, v, i) for i, v in enumerate([5, 9, 9, 0, 0, 0, 7])] + [(2, 1, 9)], "g int, v long, i int")
    assert rows(rank_within(df, "g", "v", "r"), "g", "v", "r") == sorted(
        [(1, 9, 1)] * 2 + [(1, 7, 3), (1, 5, 4)] + [(1, 0, 5)] * 3 + [(2, 1, 1)], key=repr)


def test_rank_equals_window_rank_on_a_hot_value(spark):
    from pyspark.sql import Window

    df = spark.range(6000).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).alias("v"), "id")
    w = F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))
    assert rank_within(df, "g", "v", "r").withColumn("w", w).filter("r <> w").count() == 0


@pytest.mark.parametrize("values", [[1.0], list(range(1, 101)), [3] * 50 + [7] * 49 + [100], [2, 1]])
def test_quantiles_are_exact(spark, values):
    import math

    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = [sorted(values)[math.ceil(p * len(values)) - 1] for p in (0.33, 0.66, 1.0)]
    assert exact_quantiles(df.repartition(5), "v", [0.33, 0.66, 1.0]) == want


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]


@pytest.mark.parametrize("step", ["day", "month"])
def test_dense_rows_made_from_arrays_equal_those_of_windows(spark, rows, step):
    df = series(spark, {**CELLS, 5: {0: None, 3: 2, 9: None}}).withColumns({
        "_f": F.when(F.col("e") < 3, F.lit(DAY0 - timedelta(40))), "_e": F.when(F.col("e") == 2, F.lit(DAY0 - timedelta(31)))})
    if step == "month":
        df = df.withColumns({"d": F.add_months("d", F.datediff("d", F.lit(DAY0)) % 40).cast("date")}).withColumn("d", F.trunc("d", "month"))
        df = df.groupBy("e", "d", "_f", "_e").agg(F.sum("q").alias("q")).withColumn("_f", F.trunc("_f", "month"))
    more = {"upper": F.add_months("d", 2), "step": step, "events": {"sold": F.col("q") > 0}, "carry": {"_first": "_f", "sold": "_e"}}
    what = ({"s": ("q", 7)}, {"a": ("q", 30)}, {"p": ("q", 30, 30)}, {"l": ("q", 2)})
    old = trailing(dense_series(df, ["e"], "d", ["q"], **more), ["e"], "d", *what)
    new = dense_trailing(df, ["e"], "d", ["q"], *what, **more)
    assert dict(new.dtypes) == dict(old.dtypes)
    columns = ("e", "d", "q", "s", "a", "p", "l", "sold")
    assert rows(new, *columns) == rows(old, *columns)


def test_dense_rows_are_not_sorted(spark):
    from tarnlake.plans import features

    daily = series(spark, CELLS).toDF(features.PRODUCT, features.DAY, "DailyQty")
    customers = spark.range(1, 5).select(F.col("id").alias(features.CUSTOMER), F.lit("x").alias("CustomerType"))
    bought = daily.select(F.col(features.PRODUCT).alias(features.CUSTOMER), features.DAY, "DailyQty", F.col("DailyQty").alias("_amount"))
    for out in (features.demand_of_days(daily), features.customer_of_days(bought, customers, F.lit(DAY0 + timedelta(60)))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # Windows stand below the row that makes the dense ones; before, a second one stood above it.
        assert "Window" not in plan[:plan.index("Generate explode")] and "Window" in plan


def test_product_ranks_move_no_dense_rows(spark, monkeypatch):
    from pyspark.sql import Window

    from tarnlake.plans import features

    cells = {e: {e % 5: e % 3, e % 7 + 20: 4, 60 + e % 4: e % 2} for e in range(30)}
    daily = series(spark, {**cells, 99: {0: None, 30: 2}}).toDF(features.PRODUCT, features.DAY, "DailyQty")
    monkeypatch.setattr(features, "daily_product", lambda star: daily)
    out = features.product_insights_daily({})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Before, a window ranked the dense rows of a day.
    assert "Window" not in plan[:plan.index("Generate explode")]
    w = F.rank().over(Window.partitionBy(features.DAY).orderBy(F.desc("SalesLast30Days")))
    assert out.count() == features.demand_of_days(daily).count()
    assert out.withColumn("w", w).filter("Ranking30Days <> w").isEmpty()
    monkeypatch.setattr(features, "BROADCAST_PLACES", 0)
    assert out.exceptAll(features.product_insights_daily({})).isEmpty()


def test_two_rows_of_one_date_fail(spark):
    twice = series(spark, {1: {0: 1, 3: 2}}).unionByName(series(spark, {1: {3: 2}}))
    with pytest.raises(Exception, match="two rows of one date"):
        dense_trailing(twice, ["e"], "d", ["q"], {"s": ("q", 7)}).collect()


def test_sums_are_worked_out_once_for_each_stretch(spark, rows):
    """A longer calendar gives more dense rows, not more stretches; the rows are those of ``trailing``."""
    def spec(**more):
        return Trailing(
            ["e"], "d", ["q"], {"s": ("q", 3)}, {"a": ("q", 4)}, {"b": ("q", 2, 3)}, {"l": ("q", 5)}, events={"on": F.col("q") > 1}, **more)

    found = {}
    for wide in (40, 4000):
        df = series(spark, {1: {0: 5, 1: 0, 20: 7, wide: 2}, 2: {3: 1}})
        stretches = series_stretches(pack_series(df, spec()), spec())
        dense = trailing(
            dense_series(df, ["e"], "d", ["q"], events={"on": F.col("q") > 1}), ["e"], "d", spec().sums, spec().means, spec().earlier, spec().lags)
        columns = ["e", "d", "q", "on", "s", "a", "b", "l"]
        assert rows(stretch_rows(stretches, spec()), *columns) == rows(dense, *columns)
        found[wide] = stretches.count()
    assert found[40] == found[4000] < 40


def test_places_of_values_that_last(spark, rows):
    """Ranks from rows that stand for several days are those of the days one by one."""
    lasting = [(DAY0 + timedelta(a), v, n) for a, v, n in
               [(0, 5, 3), (0, 5, 1), (1, 7, 4), (2, 0, 2), (3, 5, 2), (9, 5, 1), (4, 0, 1), (0, None, 2)]]
    df = spark.createDataFrame(lasting, "d date, v long, n int")
    days = df.select(F.explode(F.sequence("d", F.date_add("d", F.col("n") - 1))).alias("d"), "v")
    assert rows(rank_places(df, "d", "v", "r", stretch="n")) == rows(rank_places(days, "d", "v", "r"))
