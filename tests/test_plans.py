from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarnlake.plans import assistant, dims, features, gold, governance, learning, measures

MONEY = "decimal(18,4)"


@pytest.fixture(scope="module")
def star(spark):
    """Two products, one sold at a loss and once for nothing, over two years."""
    lines = [
        (1, 1, 1, 2, "100"), (2, 1, 2, 1, "5"), (3, 2, 2, 3, "0"), (4, 3, 1, 1, "80"), (5, 4, 2, 1, "20"),
    ]
    orders = [(1, 1, 20230110, 1, "105"), (2, 1, 20230210, 1, "10"), (3, 2, 20240115, -1, "80"), (4, 2, 19000101, 1, "20")]
    return {
        "fact_sales_order_detail": spark.createDataFrame(
            [(s, o, p, q, Decimal(v)) for s, o, p, q, v in lines],
            f"SalesID long, OrderID long, Product_SK long, OrderQty int, LineTotal {MONEY}"),
        "fact_sales_order": spark.createDataFrame(
            [(o, c, d, cur, 1, 1, Decimal(v), Decimal("1"), Decimal("2")) for o, c, d, cur, v in orders],
            "OrderID long, Customer_SK long, OrderDate_SK int, Currency_SK long, Location_SK long, Territory_SK long, "
            f"SubTotal {MONEY}, ShippingCost {MONEY}, TaxAmt {MONEY}"),
        "dim_product": spark.createDataFrame(
            [(1, 11, "bike-1", "Bikes", "Road", Decimal("30"), 1), (2, 12, "cap", "Not registered", "Not registered", Decimal("8"), 0)],
            f"Product_SK long, ProductID int, ProductName string, Category string, SubCategory string, StandardCost {MONEY}, FinishedGoodsFlag int"),
        "dim_location": spark.createDataFrame([(1, "C", "S", "N")], "Location_SK long, City string, StateProvinceName string, CountryName string"),
        "dim_territory": spark.createDataFrame(
            [(1, "T", "G", "TT"), (-1, "none", "none", "none")],
            "Territory_SK long, TerritoryName string, TerritoryGroup string, CountryRegionCode string"),
        "dim_currency": spark.createDataFrame([(1, "USD"), (-1, "UNK")], "Currency_SK long, ToCurrencyCode string"),
        "dim_customer": spark.createDataFrame(
            [(1, 1, "PERSON", "Ann", "x"), (2, 2, "STORE", "Not registered", "Shop")],
            "Customer_SK long, CustomerID int, CustomerType string, PersonName string, StoreName string"),
        "dim_date": dims.dim_date(spark, "2023-01-01", "2024-12-31"),
        "fact_purchases": spark.createDataFrame(
            [(1, 1, 1, 1, 20230110, 5, Decimal("50"), Decimal("70"), Decimal("1"), Decimal("2")),
             (2, 1, 2, 1, 20230110, 4, Decimal("20"), Decimal("70"), Decimal("1"), Decimal("2"))],
            "PurchaseID long, OrderID long, Product_SK long, Supplier_SK long, OrderDate_SK int, OrderQty int, "
            f"LineTotal {MONEY}, SubTotal {MONEY}, TaxAmt {MONEY}, ShippingCost {MONEY}"),
    }


def test_profitability_with_losses_and_free_goods(star, rows):
    got = rows(gold.profitability(star), "ProductID", "Year", "Currency", "Revenue", "Profit", "ProfitMargin", "ProfitabilityStatus")
    # Order 4 has a day outside the calendar, so its line drops out of the inner joins.
    assert [(p, y, c, float(r), float(v), m, s) for p, y, c, r, v, m, s in got] == [
        (11, 2023, "USD", 100.0, 40.0, 0.4, "Profitable"), (11, 2024, "UNK", 80.0, 50.0, 0.625, "Profitable"),
        (12, 2023, "USD", 0.0, -24.0, 0.0, "Not Profitable"), (12, 2023, "USD", 5.0, -3.0, -0.6, "Not Profitable")]


def test_loss_makers_use_the_mean_of_margins(star):
    out = gold.loss_makers(gold.profitability(star)).collect()
    assert [(r.ProductName, r.AvgProfitMargin) for r in out] == [("cap", -0.3)]


def test_best_sellers_take_the_last_two_years(star, rows):
    got = rows(gold.revenue_against_cost(star), "ProductShortName", "TotalRevenue")
    assert [(n, float(v)) for n, v in got] == [("B1-1", 180.0), ("C-", 5.0)]
    assert gold.recent_years(gold.yearly_totals(star), 1).count() == 1


def test_loss_alert_looks_at_the_latest_year(star):
    lost = gold.loss_alert(star)
    assert lost.count() == 0
    assert gold.alert_fires(lost).first().Alert is False


def test_filters_and_counts(star, rows):
    prof = gold.profitability(star)
    assert rows(gold.filter_values(prof, "Year", F.col("Currency") == "USD")) == [(2023, 3), (2024, 0)]
    assert gold.filtered(prof, Year=[2024], Category=["Bikes"]).count() == 1


def test_customer_view_keeps_orders_without_a_day(star, rows):
    got = rows(assistant.customer_view(star).filter("OrderID = 4"), "FullDate", "PersonName", "TotalRevenue")
    assert [(d, n, float(v)) for d, n, v in got] == [(None, "Not registered", 23.0)]


def test_purchase_costs_split(star):
    r = gold.purchases_for_bi(star).first()
    assert [float(x) for x in (r.Purchases, r.Variable_Costs, r.Fixed_Costs)] == [70.0, 3.0, 67.0]


def test_purchase_subtotal_counts_an_order_once(star):
    assert float(measures.subtotal(star["fact_purchases"]).first().SubTotalValue) == 70.0


def test_total_profit_joins_two_facts(star, rows):
    got = rows(measures.total_profit(star, "Year"), "Year", "TotalProfit")
    assert [(y, float(v)) for y, v in got] == [(2023, 35.0), (2024, 80.0)]


def test_previous_month_is_null_after_a_gap(star, rows):
    got = rows(measures.monthly_sales(star), "MonthStart", "SoldVolume", "SoldVolumePreviousMonth")
    assert got == [(date(2023, 1, 1), 3, None), (date(2023, 2, 1), 3, 3), (date(2024, 1, 1), 1, None)]


def test_rollup_levels_add_up(star, rows):
    got = {r[0]: r for r in rows(measures.product_drill(star).filter("Level = 3 or Level = 7"), "Category", "SoldVolume")}
    assert got["Miscellaneous"][1] == 5 and got["Bikes"][1] == 3 and got[None][1] == 8


def test_lines_and_orders_as_unit_of_first_days(star, rows):
    lines = rows(features.customer_first_days(star).filter("Customer_SK = 1"), "TotalOrdersFirst90Days", "SpendFirst90Days", "DaysToRepurchase")
    assert [(n, float(v), d) for n, v, d in lines] == [(3, 220.0, 15.5)]
    orders = rows(features.customer_first_days(star, per_order=True).filter("Customer_SK = 1"), "TotalOrdersFirst90Days", "SpendFirst90Days", "DaysToRepurchase")
    assert [(n, float(v), d) for n, v, d in orders] == [(2, 115.0, 31.0)]


def test_region_growth_is_null_without_a_previous_period(star):
    out = features.region_daily(star)
    assert out.filter("Territory_SK = -1").count() == 0
    assert out.filter("Growth30Days is null").count() == 30
    assert out.filter("Growth30Days is null and TrendDirection <> 0").count() == 0


def test_customer_days_end_a_year_after_the_last_sale(star):
    out = features.customer_daily(star)
    last = out.groupBy("Customer_SK").agg(F.max("ReferenceDate").alias("d")).orderBy("Customer_SK").collect()
    assert [r.d for r in last] == [date(2024, 1, 15)] * 2
    r = out.filter("Customer_SK = 1 and ReferenceDate = date'2023-05-01'").first()
    assert (r.DaysSinceLastPurchase, r.CustomerInactiveFlag, r.LowFrequencyFlag, r.CustomerType) == (80, 1, 0, "PERSON")


def test_never_bought_is_999_and_not_flagged(star):
    out = features.inventory_product_daily(star).filter("Product_SK = 2")
    assert {(r.DaysSinceLastPurchase, r.NoRecentPurchaseFlag) for r in out.collect()} == {(999, 0)}


def test_region_share_does_not_multiply_rows(star):
    out = features.product_region_daily(star)
    assert out.count() == out.select("ReferenceDate", "Product_SK", "Territory_SK").distinct().count() == 4
    assert {r.ProductRegionPerformanceCategory for r in out.filter("SalesAmountProduct30Days > 0").collect()} == {"Strong Region"}


def test_model_series_keeps_both_rows_of_a_month(spark):
    months = spark.createDataFrame([(date(2024, m, 1), float(m)) for m in range(1, 6)], "YearMonth date, label double")
    extra = spark.createDataFrame([(date(2024, 5, 1), 50.0)], "YearMonth date, label double")
    got = [(r.label, r.lag_1_month, r.lag_3_month, r.rolling_mean_3m) for r in features.model_series(months, extra).orderBy("YearMonth", "label").collect()]
    assert got == [(4.0, 3.0, 1.0, 2.0), (5.0, 4.0, 2.0, 3.0), (50.0, 5.0, 3.0, 4.0)]


def test_recent_runs(spark):
    log = spark.sql("select 'a' ADFRunID, timestamp'2024-01-02 00:00:00' StartTime union all select 'b', timestamp'2024-01-01 00:00:00'")
    now = F.lit("2024-01-02 12:00:00").cast("timestamp")
    assert governance.recent_runs(log, now).first().RecentRuns == 1


def test_split_is_stable_and_complete(spark):
    df = spark.range(5000)
    train, test = learning.split(df, "id")
    again, _ = learning.split(df.repartition(7), "id")
    assert train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83
    assert train.join(test, "id").count() == 0
    assert train.join(again, "id").count() == train.count() == again.count()


def test_forest_learns_a_plain_rule(spark):
    names = list(learning.TIER_FEATURES)
    df = spark.range(600).select(
        F.col("id").alias("k"),
        *[(F.col("id") % 97 * (i + 1)).cast("double").alias(n) for i, n in enumerate(names)],
        F.when(F.col("id") % 97 > 60, "GOLD").when(F.col("id") % 97 > 30, "SILVER").otherwise("BRONZE").alias("ClientRank"))
    train, test = learning.split(learning.prepare(df), "k")
    model = learning.fit_forest(train, trees=10)
    out = model.transform(test)
    metrics = {r.metric: r.value for r in learning.scores(out).collect()}
    assert set(metrics) == {"accuracy", "precision", "recall", "f1"} and metrics["accuracy"] > 0.9
    matrix = learning.confusion(out).collect()
    assert sum(sum(r[1:]) for r in matrix) == test.count()
    assert abs(sum(r.importance for r in learning.importances(model, spark).collect()) - 1) < 1e-6


def test_smape(spark):
    df = spark.createDataFrame([(100.0, 50.0), (0.0, 0.0)], "a double, p double")
    assert learning.smape(df, "a", "p").first().smape == pytest.approx(100 / 2 * (2 * 50 / 150))


def test_forecast_of_a_growing_season(spark):
    """Each month is 10 above the same month a year before."""
    months = [(1, date(2020 + i // 12, i % 12 + 1, 1), float(i % 12 + 10 * (i // 12))) for i in range(36)]
    short = [(2, date(2022, 12, 1), 7.0)]
    df = spark.createDataFrame(months + short, "e int, m date, v double")
    out = learning.seasonal_forecast(df, ["e"], "m", "v", "2022-11-01", "2024-03-01").collect()
    got = {(r.e, r.date): r.prediction for r in out}
    assert got[1, date(2023, 4, 1)] == 33.0 and got[1, date(2024, 3, 1)] == 42.0
    assert got[2, date(2023, 5, 1)] == 7.0
    assert min(d for _, d in got) == date(2023, 1, 1) and len(got) == 30


def test_cuts_are_exact_quantiles_of_every_column(spark):
    import random

    from tarnlake.operators.quantiles import exact_cuts

    r = random.Random(1)
    values = [(r.randrange(50) * 1.0, r.random(), None if k % 3 else 7.0, 2.0) for k in range(1000)]
    df = spark.createDataFrame(values, "a double, b double, c double, d double").repartition(7)
    found = exact_cuts(df, ["a", "b", "c", "d"], 8)
    for i, name in enumerate("abcd"):
        known = sorted(v[i] for v in values if v[i] is not None)
        assert found[name] == sorted({known[-(-j * len(known) // 8) - 1] for j in range(1, 8)}), name
    assert exact_cuts(df.limit(0), ["a"], 4) == {"a": []}


def test_trees_learn_a_plain_rule_and_do_not_depend_on_partitions(spark, rows):
    from tarnlake.operators import trees

    df = spark.range(900).selectExpr(
        "id AS k", "CAST(id % 97 AS DOUBLE) AS x", "CAST(id % 13 AS DOUBLE) AS noise", "IF(id % 5 = 0, NULL, CAST(id % 7 AS DOUBLE)) AS gaps",
        "CASE WHEN id % 97 > 60 THEN 2 WHEN id % 97 > 30 THEN 1 ELSE 0 END AS label")
    train, test = trees.split_by_key(df, "k")
    assert abs(train.count() / 900 - 0.8) < 0.06 and train.join(test, "k").isEmpty()
    s = trees.Settings(trees=6, depth=3, columns=2)
    one = trees.fit(train, "k", "label", ["x", "noise", "gaps"], 3, s)
    two = trees.fit(train.repartition(9), "k", "label", ["x", "noise", "gaps"], 3, s)
    assert rows(one.splits) == rows(two.splits) and rows(one.leaves) == rows(two.leaves)
    told = trees.predict(test, one)
    assert told.filter("label = prediction").count() > 0.9 * test.count() and told.columns == [*test.columns, "prediction", "confidence"]
    assert told.filter("confidence > 1 OR confidence < 1 / 3.0").isEmpty()
    shares = {r.feature: r.importance for r in trees.importances(one).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and max(shares, key=shares.get) == "x"
    # One class only: no split, and every row is told that class.
    flat = trees.fit(train.withColumn("label", F.lit(1)), "k", "label", ["x"], 3, s)
    assert flat.splits.isEmpty() and trees.predict(test, flat).filter("prediction <> 1 OR confidence <> 1").isEmpty()


def test_nodes_draw_their_features_once_and_not_for_every_row(spark):
    import hashlib

    from tarnlake.operators import trees

    s = trees.Settings(trees=2, columns=2)
    forest = trees.Forest(["a", "b", "c"], {}, 2, s, None, None)
    nodes = spark.createDataFrame([(0, 1), (1, 2), (1, 3)], "tree int, node int")
    seen = {}
    for r in trees._looks(nodes, forest).collect():
        seen.setdefault((r.tree, r.node), set()).add(r.feature)
    for (t, n), features in seen.items():
        hashes = [hashlib.md5(f"{s.seed}:{t}:{n}:{g}".encode()).hexdigest() for g in range(3)]
        assert features == {g for g in range(3) if sum(h < hashes[g] for h in hashes) < 2}
    assert len(seen) == 3
    placed = spark.createDataFrame([(0, 1, 0, 1, [0, 1, 2])], "tree int, node int, label int, weight int, bins array<int>")
    plan = trees._best_splits(placed, nodes, forest, 0)._jdf.queryExecution().optimizedPlan().toString()
    # Before, the optimizer put the draw into a filter below the sums, where it was hashed for each row and feature.
    assert not [line for line in plan.splitlines() if "Filter" in line and "md5" in line]
