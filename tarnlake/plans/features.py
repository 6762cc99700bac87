"""Feature tables over the star schema.

Raw lines are summed to one row per entity and day before anything is windowed; the
partial sums run inside the tasks, so a product or customer with a third of all lines
reaches the window as at most one row per day. Windows of one table share a single
partitioning and order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions.scalars import (
    calendar_parts,
    days_since,
    direction,
    flag,
    growth,
    ratio,
)
from tarnlake.operators.quantiles import exact_quantiles
from tarnlake.operators.timeseries import (
    Trailing,
    dense_series,
    dense_trailing,
    densify,
    pack_series,
    rank_places,
    series_stretches,
    series_window,
    trailing,
    trailing_days,
    unpack_series,
)
from tarnlake.plans.gold import Star
from tarnlake.session import checkpointed

DAY, MONTH = "ReferenceDate", "ReferenceMonth"
PRODUCT, CUSTOMER, TERRITORY = "Product_SK", "Customer_SK", "Territory_SK"


def dated_lines(star: Star) -> DataFrame:
    """Sales lines with the keys and day of their order."""
    orders = (
        star["fact_sales_order"]
        .join(star["dim_date"].select("DateKey", "FullDate"), F.col("OrderDate_SK") == F.col("DateKey"))
        .select("OrderID", CUSTOMER, TERRITORY, F.col("FullDate").alias(DAY))
    )
    return (
        star["fact_sales_order_detail"]
        .select("OrderID", PRODUCT, "OrderQty", "LineTotal")
        .join(orders, "OrderID")
    )


def _daily_purchases(star: Star) -> DataFrame:
    """Purchases per product day; summed before the product flag is looked up."""
    return (
        star["fact_purchases"]
        .groupBy(PRODUCT, "OrderDate_SK")
        .agg(F.sum("OrderQty").cast("long").alias("PurchaseQty"))
        .join(star["dim_date"].select("DateKey", "FullDate"), F.col("OrderDate_SK") == F.col("DateKey"))
        .join(star["dim_product"].select(PRODUCT, "FinishedGoodsFlag"), PRODUCT)
        .select(PRODUCT, F.col("FullDate").alias(DAY), "PurchaseQty", "FinishedGoodsFlag")
    )


def daily_product(star: Star) -> DataFrame:
    return dated_lines(star).groupBy(PRODUCT, DAY).agg(F.sum("OrderQty").cast("long").alias("DailyQty"))


def demand_product_daily(star: Star, keep: Sequence[str] | None = None) -> DataFrame:
    """Daily demand per product: trailing sums and means, sale frequency, lags.

    ``keep`` limits the output; unused windows are then pruned by the optimizer.
    """
    return demand_of_days(daily_product(star), keep)


def _demand() -> Trailing:
    spans = (7, 30, 90, 365)
    return Trailing(
        [PRODUCT], DAY, ["DailyQty", "_sold"],
        {**{f"SalesLast{n}Days": ("DailyQty", n) for n in spans}, "_sold30": ("_sold", 30)},
        {f"AvgSalesLast{n}Days": ("DailyQty", n) for n in spans},
        lags={f"Lag{k}": ("DailyQty", k) for k in (1, 7, 30, 90, 365)},
        events={"_last_sale": F.col("DailyQty") > 0},
    )


def demand_series(daily: DataFrame) -> DataFrame:
    """Sums per product and day as one row per product, of which ``demand_of_series`` makes the features of every day."""
    return pack_series(daily.withColumn("_sold", (F.col("DailyQty") > 0).cast("long")), _demand())


def demand_of_series(series: DataFrame) -> DataFrame:
    spec = _demand()
    return unpack_series(series, spec).select(
        PRODUCT, DAY, "DailyQty",
        *[n for n in spec.sums if n != "_sold30"],
        *spec.means,
        (F.col("_sold30") / F.lit(30.0)).alias("Intermittency30Days"),
        days_since(DAY, "_last_sale").alias("DaysSinceLastSale"),
        *spec.lags,
        (F.col("DailyQty") - F.col("Lag7")).alias("Trend7"),
        *[c.alias(n) for n, c in calendar_parts(DAY).items()],
    )


def demand_of_days(daily: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """The same from sums per product and day."""
    out = demand_of_series(demand_series(daily))
    return out.select(*keep) if keep else out


def _monthly_demand() -> Trailing:
    spans = (3, 6, 12)
    return Trailing(
        [PRODUCT], MONTH, ["MonthlyQty"],
        {f"SalesLast{n}Months": ("MonthlyQty", n) for n in spans},
        {f"AvgSalesLast{n}Months": ("MonthlyQty", n) for n in spans},
        lags={f"Lag{k}Month": ("MonthlyQty", k) for k in (1, 3, 12)},
        step="month", events={"_last_sale": F.col("MonthlyQty") > 0},
    )


def monthly_demand_series(star: Star) -> DataFrame:
    """Monthly sums as one row per product, of which ``monthly_demand_of_series`` makes the features of every month."""
    monthly = (
        dated_lines(star)
        .groupBy(PRODUCT, F.trunc(DAY, "month").alias(MONTH))
        .agg(F.sum("OrderQty").cast("long").alias("MonthlyQty"))
    )
    return pack_series(monthly, _monthly_demand())


def monthly_demand_of_series(series: DataFrame) -> DataFrame:
    spec = _monthly_demand()
    return unpack_series(series, spec).select(
        PRODUCT, MONTH, "MonthlyQty",
        *spec.sums,
        *spec.means,
        F.coalesce(F.datediff(MONTH, "_last_sale") / F.lit(30.0), F.lit(999.0)).alias("MonthsSinceLastSale"),
        *spec.lags,
        (F.col("MonthlyQty") - F.col("Lag3Month")).alias("Trend3Months"),
        F.month(MONTH).alias("MonthNumber"),
        F.year(MONTH).alias("YearNumber"),
    )


def demand_product_monthly(star: Star) -> DataFrame:
    return monthly_demand_of_series(monthly_demand_series(star))


def monthly_value(star: Star) -> DataFrame:
    return (
        dated_lines(star)
        .groupBy(F.trunc(DAY, "month").alias(MONTH))
        .agg(F.sum("LineTotal").alias("MonthlySalesAmount"))
    )


def demand_value_monthly(star: Star) -> DataFrame:
    """Company series; after the sum it has one row per month, so its windows may run
    unpartitioned."""
    spans, steps = (3, 6, 12), (1, 3, 12)
    amount = "MonthlySalesAmount"
    months = dense_series(
        monthly_value(star), [], MONTH, [amount], step="month",
        events={"_last_sale": F.col(amount) > 0},
    )
    months = trailing(
        months, [], MONTH,
        {f"SalesAmountLast{n}Months": (amount, n) for n in spans},
        {f"AvgSalesAmountLast{n}Months": (amount, n) for n in spans},
        lags={f"LagAmount{k}Month": (amount, k) for k in steps},
    )
    return months.select(
        MONTH, amount,
        *[f"SalesAmountLast{n}Months" for n in spans],
        *[f"AvgSalesAmountLast{n}Months" for n in spans],
        F.coalesce(F.floor(F.months_between(MONTH, "_last_sale")), F.lit(999)).alias("MonthsSinceLastSaleAmount"),
        *[f"LagAmount{k}Month" for k in steps],
        (F.col(amount) - F.col("LagAmount3Month")).alias("TrendAmount3Months"),
        F.month(MONTH).alias("MonthNumber"),
        F.year(MONTH).alias("YearNumber"),
    )


def _stock_flags(ratio_col: Column) -> dict[str, Column]:
    return {
        "OverstockRiskFlag": flag(ratio_col > 1.2),
        "StockoutRiskFlag": flag(ratio_col < 0.8),
    }


def insights_overview_daily(star: Star) -> DataFrame:
    """Company sales against purchases per day of the sales period. Both sides are
    summed to one row per day first; the rest works on that calendar-sized table."""
    sales = (
        dated_lines(star).groupBy(DAY).agg(F.sum("OrderQty").cast("long").alias("TotalSalesQty"))
    )
    finished = F.col("FinishedGoodsFlag") == 1
    component = F.col("FinishedGoodsFlag") == 0
    qty = F.col("PurchaseQty")
    bought = _daily_purchases(star).groupBy(DAY).agg(
        F.sum(qty).alias("TotalPurchaseQty"),
        F.sum(F.when(finished, qty).otherwise(0)).alias("PurchaseFinishedQty"),
        F.sum(F.when(component, qty).otherwise(0)).alias("PurchaseComponentQty"),
    )
    parts = ("TotalPurchaseQty", "PurchaseFinishedQty", "PurchaseComponentQty")
    days = densify(sales, [], DAY, ["TotalSalesQty"]).join(bought, DAY, "left")
    days = days.withColumns({c: F.coalesce(c, F.lit(0)) for c in parts})
    days = trailing(
        days, [], DAY,
        {"SalesLast30Days": ("TotalSalesQty", 30), "PurchasesFinishedLast30Days": ("PurchaseFinishedQty", 30)},
        earlier={"_prev": ("TotalSalesQty", 30, 30)},
    )
    stock = ratio("PurchasesFinishedLast30Days", "SalesLast30Days", at_zero=None)
    return days.select(
        DAY, "TotalSalesQty", *parts, "SalesLast30Days",
        F.coalesce("_prev", F.lit(0)).alias("SalesPrev30Days"),
        "PurchasesFinishedLast30Days",
        growth("SalesLast30Days", "_prev").alias("Growth30Days"),
        F.coalesce(stock, F.lit(0.0)).alias("PurchaseSalesRatio"),
        *[c.alias(n) for n, c in _stock_flags(stock).items()],
    )


def inventory_product_daily(star: Star) -> DataFrame:
    """Sales against purchases per product day.

    Daily sales and purchases are stacked and summed rather than joined; purchase days
    outside a product's sales period are then dropped, and one pass over the product's
    days does the rest.
    """
    sold = daily_product(star).select(
        PRODUCT, DAY, F.col("DailyQty").alias("SalesQty"), F.lit(0).cast("long").alias("PurchaseQty"),
        F.lit(True).alias("_sale"),
    )
    bought = (
        _daily_purchases(star)
        .filter("FinishedGoodsFlag = 1")
        .select(PRODUCT, DAY, F.lit(0).cast("long").alias("SalesQty"), "PurchaseQty", F.lit(False).alias("_sale"))
    )
    whole = Window.partitionBy(PRODUCT)
    sale_day = F.when(F.col("_sale"), F.col(DAY))
    days = (
        sold.unionByName(bought)
        .groupBy(PRODUCT, DAY)
        .agg(F.sum("SalesQty").alias("SalesQty"), F.sum("PurchaseQty").alias("PurchaseQty"), F.max("_sale").alias("_sale"))
        .withColumns({"_from": F.min(sale_day).over(whole), "_to": F.max(sale_day).over(whole)})
        .filter(F.col(DAY).between(F.col("_from"), F.col("_to")))
        .drop("_sale", "_from", "_to")
    )
    days = dense_trailing(
        days, [PRODUCT], DAY, ["SalesQty", "PurchaseQty"],
        {"SalesLast30Days": ("SalesQty", 30), "PurchasesLast30Days": ("PurchaseQty", 30)},
        events={"_last": F.col("PurchaseQty") > 0},
    )
    stock = ratio("PurchasesLast30Days", "SalesLast30Days", at_zero=None)
    flags = _stock_flags(stock)
    return days.select(
        PRODUCT, DAY, "SalesLast30Days", "PurchasesLast30Days",
        F.coalesce(stock, F.lit(0.0)).alias("PurchaseSalesRatio"),
        days_since(DAY, "_last").alias("DaysSinceLastPurchase"),
        flags["StockoutRiskFlag"].alias("StockoutRiskFlag"),
        flags["OverstockRiskFlag"].alias("OverstockRiskFlag"),
        flag(F.datediff(DAY, "_last") >= 30).alias("NoRecentPurchaseFlag"),
    )


def customer_daily(star: Star) -> DataFrame:
    """Customer days from the first sale to a year after the last, at most to the end
    of the data."""
    # Stored once: the last day of all is looked up in it, and lines and orders must not be joined again for that.
    daily = checkpointed(dated_lines(star).groupBy(CUSTOMER, DAY).agg(
        F.sum("OrderQty").cast("long").alias("DailyQty"), F.sum("LineTotal").alias("_amount")
    ))
    return customer_of_days(daily, star["dim_customer"], daily.agg(F.max(DAY)).scalar())


# Days that a customer's series goes on after the last sale.
CUSTOMER_TAIL = 365


def _customer_days() -> Trailing:
    return Trailing(
        [CUSTOMER, "CustomerType"], DAY, ["DailyQty", "_amount"],
        {"SalesQtyLast30Days": ("DailyQty", 30), "SalesAmountLast30Days": ("_amount", 30)},
        earlier={"_prev": ("DailyQty", 30, 30)}, events={"_last": F.col("DailyQty") > 0},
    )


def customer_series(daily: DataFrame, customers: DataFrame, end: Column) -> DataFrame:
    """Sums per customer and day as one row per customer, of which ``customer_of_series`` makes the features of every day;
    ``end``: the last day of all data."""
    last = F.least(F.date_add(DAY, CUSTOMER_TAIL), end)
    # The type joins the days with sales and is carried along, not the dense rows.
    return pack_series(daily.join(customers.select(CUSTOMER, "CustomerType"), CUSTOMER), _customer_days(), last)


def customer_of_days(daily: DataFrame, customers: DataFrame, end: Column) -> DataFrame:
    """The same from sums per customer and day, some customers' or all; ``end``: the last day of all data."""
    return customer_of_series(customer_series(daily, customers, end))


def customer_of_series(series: DataFrame) -> DataFrame:
    days = unpack_series(series, _customer_days())
    qty = F.col("SalesQtyLast30Days")
    return days.select(
        CUSTOMER, DAY, "DailyQty", "SalesQtyLast30Days",
        F.coalesce("_prev", F.lit(0)).alias("SalesPrev30Days"),
        growth("SalesQtyLast30Days", "_prev").alias("Growth30Days"),
        "SalesAmountLast30Days",
        ratio("SalesAmountLast30Days", "SalesQtyLast30Days").alias("AvgTicket30Days"),
        days_since(DAY, "_last").alias("DaysSinceLastPurchase"),
        flag(F.datediff(DAY, "_last") >= 60).alias("CustomerInactiveFlag"),
        flag((qty > 0) & (qty < 5)).alias("LowFrequencyFlag"),
        "CustomerType",
    )


# Places of a rank that are broadcast; beyond, they meet the rows in a shuffle join.
BROADCAST_PLACES = 3_000_000


def product_insights_daily(star: Star) -> DataFrame:
    """Growth, trend, rank and activity per product day."""
    # Stored once: the places of a day's values and the output are made from it.
    daily = checkpointed(daily_product(star))
    spec = Trailing(
        [PRODUCT], DAY, ["DailyQty"],
        {"SalesLast7Days": ("DailyQty", 7), "SalesLast30Days": ("DailyQty", 30)},
        earlier={"_prev30": ("DailyQty", 30, 30), "_prev7": ("DailyQty", 7, 7)}, events={"_last": F.col("DailyQty") > 0},
    )
    days = unpack_series(pack_series(daily, spec), spec).select(
        PRODUCT, DAY, "DailyQty", "SalesLast7Days", "SalesLast30Days",
        F.coalesce("_prev30", F.lit(0)).alias("SalesPrev30Days"),
        growth("SalesLast30Days", "_prev30").alias("Growth30Days"),
        F.coalesce(F.col("SalesLast7Days") - F.col("_prev7"), F.lit(0)).alias("Trend7"),
        days_since(DAY, "_last").alias("DaysSinceLastSale"),
    )
    # A day's products share few totals, so counts per total are small; dense rows are neither sorted, moved nor counted.
    only = Trailing([PRODUCT], DAY, [], {"SalesLast30Days": ("DailyQty", 30)})
    totals = series_stretches(pack_series(daily, only), only).select(
        F.date_add("_from", F.col("_pos")).alias(DAY), "SalesLast30Days", (F.col("_next") - F.col("_pos")).alias("_days"))
    places = checkpointed(rank_places(totals, DAY, "SalesLast30Days", "Ranking30Days", stretch="_days"))
    if places.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    ranked = days.join(
        places.select(F.col(DAY).alias("_day"), F.col("SalesLast30Days").alias("_total"), "Ranking30Days"),
        (F.col(DAY) == F.col("_day")) & F.col("SalesLast30Days").eqNullSafe(F.col("_total")))
    change, sold = F.col("Growth30Days"), F.col("SalesLast30Days")
    return ranked.select(
        PRODUCT, DAY, "DailyQty", "SalesLast7Days", "SalesLast30Days", "SalesPrev30Days",
        "Growth30Days", "Trend7", "DaysSinceLastSale", "Ranking30Days",
        flag(change <= -0.5).alias("SharpDropFlag"),
        flag(change >= 0.5).alias("HighGrowthFlag"),
        flag(F.col("DaysSinceLastSale") >= 30).alias("NoSalesRecentFlag"),
        direction(change).alias("TrendDirection"),
        F.when(sold == 0, 0).when(sold < 10, 1).otherwise(2).alias("ActivityLevel"),
    )


def product_region_daily(star: Star) -> DataFrame:
    """Share of a territory in a product's trailing sales, on days with sales."""
    sales = (
        dated_lines(star)
        .groupBy(DAY, PRODUCT, TERRITORY)
        .agg(F.sum("OrderQty").cast("long").alias("SalesQty"), F.sum("LineTotal").alias("SalesAmount"))
        .join(star["dim_territory"].select(TERRITORY, "TerritoryName"), TERRITORY)
    )
    # One shuffle on the product serves both windows: the finer one is inside it.
    sales = sales.repartition(PRODUCT)
    rows = trailing_days(sales, [PRODUCT, TERRITORY], DAY, "SalesAmount", 30, "SalesAmountRegion30Days")
    rows = trailing_days(rows, [PRODUCT], DAY, "SalesAmount", 30, "SalesAmountProduct30Days")
    total = F.col("SalesAmountProduct30Days")
    share = ratio("SalesAmountRegion30Days", "SalesAmountProduct30Days")
    return rows.select(
        DAY, PRODUCT, TERRITORY, "TerritoryName", "SalesQty", "SalesAmount",
        "SalesAmountRegion30Days", "SalesAmountProduct30Days", share.alias("RegionShare"),
        F.when(total == 0, "No Sales")
        .when(share > 0.4, "Strong Region")
        .when(share < 0.1, "Growth Opportunity")
        .otherwise("Moderate")
        .alias("ProductRegionPerformanceCategory"),
    )


def region_daily(star: Star) -> DataFrame:
    """Every known territory on every day of the sales period."""
    regions = star["dim_territory"].select(TERRITORY, "TerritoryName")
    sales = (
        dated_lines(star)
        .join(regions.select(TERRITORY), TERRITORY)
        .groupBy(TERRITORY, DAY)
        .agg(F.sum("OrderQty").cast("long").alias("SalesQty"), F.sum("LineTotal").alias("SalesAmount"))
    )
    # Territories x days at most: stored once, so the fact join runs once for both uses.
    sales = checkpointed(sales)
    span = sales.agg(F.struct(F.min(DAY).alias("a"), F.max(DAY).alias("b"))).scalar()
    grid = regions.filter(F.col(TERRITORY) != -1).select(
        TERRITORY, "TerritoryName",
        F.explode(F.sequence(span["a"], span["b"], F.expr("interval 1 day"))).alias(DAY),
    )
    zero = F.lit(0).cast(sales.schema["SalesAmount"].dataType)
    days = grid.join(sales, [TERRITORY, DAY], "left").select(
        TERRITORY, "TerritoryName", DAY,
        F.coalesce("SalesQty", F.lit(0).cast("long")).alias("SalesQty"),
        F.coalesce("SalesAmount", zero).alias("SalesAmount"),
    )
    days = trailing(
        days, [TERRITORY], DAY,
        {"SalesQtyLast30Days": ("SalesQty", 30), "SalesAmountLast30Days": ("SalesAmount", 30)},
        earlier={"_prev": ("SalesAmount", 30, 30)},
    )
    change = growth("SalesAmountLast30Days", "_prev", on_null=None)
    return days.withColumn("Growth30Days", change).select(
        TERRITORY, "TerritoryName", DAY, "SalesQty", "SalesAmount", "SalesQtyLast30Days",
        "SalesAmountLast30Days",
        F.coalesce(F.col("_prev").cast("double"), F.lit(0.0)).alias("SalesAmountPrev30Days"),
        "Growth30Days",
        direction("Growth30Days").alias("TrendDirection"),
        flag(F.col("Growth30Days") >= 0.3).alias("HighGrowthFlag"),
        flag(F.col("Growth30Days") <= -0.3).alias("SharpDropFlag"),
    )


def customer_first_days(star: Star, days: int = 90, per_order: bool = False) -> DataFrame:
    """Behaviour of each customer in the days after the first purchase.

    Order lines are the unit, so an order's subtotal counts once per line;
    ``per_order`` counts orders instead. Lines are summed per customer, day, product
    before the first day is joined back. Orders of unknown day count in the history only.
    """
    goods = star["dim_product"].select(PRODUCT, "SubCategory")
    orders = star["fact_sales_order"].select(
        "OrderID", CUSTOMER, "SubTotal",
        F.expr("try_to_date(cast(OrderDate_SK as string), 'yyyyMMdd')").alias("_day"),
    ).filter("_day is not null")
    lines = star["fact_sales_order_detail"].select("OrderID", PRODUCT).join(goods, PRODUCT)
    bought = orders.join(lines, "OrderID")
    unit = ("OrderID",) if per_order else ()
    cells = bought.groupBy(CUSTOMER, "_day", PRODUCT, "SubCategory", *unit).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("SubTotal").alias("_spend"), F.max("SubTotal").alias("_one")
    )
    first = cells.groupBy(CUSTOMER).agg(F.min("_day").alias("_first"))
    early = cells.join(first, CUSTOMER).filter(F.datediff("_day", "_first") <= days)
    diversity = early.groupBy(CUSTOMER).agg(
        F.count_distinct("SubCategory").alias("CategoryDiversity"),
        F.count_distinct(PRODUCT).alias("ProductDiversity"),
        F.sum("_n").alias("_n"), F.sum("_spend").alias("_spend"),
        F.min("_day").alias("_from"), F.max("_day").alias("_to"),
    )
    if per_order:
        heads = early.groupBy(CUSTOMER, "OrderID").agg(F.max("_one").alias("_one"))
        heads = heads.groupBy(CUSTOMER).agg(F.count(F.lit(1)).alias("_n"), F.sum("_one").alias("_spend"))
        diversity = diversity.drop("_n", "_spend").join(heads, CUSTOMER)
    history = star["fact_sales_order"].groupBy(CUSTOMER).agg(F.sum("SubTotal").alias("TotalHistoricalValue"))
    n = F.col("_n")
    return diversity.join(history, CUSTOMER).select(
        CUSTOMER,
        n.alias("TotalOrdersFirst90Days"),
        F.col("_spend").alias("SpendFirst90Days"),
        "TotalHistoricalValue",
        ratio("_spend", n).alias("AvgTicketFirst90Days"),
        "CategoryDiversity", "ProductDiversity",
        F.when(n > 1, F.datediff("_to", "_from") / (n - 1)).otherwise(F.lit(90.0)).alias("DaysToRepurchase"),
    )


def customer_classification(star: Star, per_order: bool = False) -> DataFrame:
    """First-days behaviour with the value tier by the 33 and 66 percent points. The
    rows, one per customer, are stored once for both."""
    rows = checkpointed(customer_first_days(star, per_order=per_order))
    value = F.col("TotalHistoricalValue")
    p33, p66 = exact_quantiles(rows, "TotalHistoricalValue", [0.33, 0.66])
    tier = F.when(value >= p66, "GOLD").when(value >= p33, "SILVER").otherwise("BRONZE")
    return rows.withColumn("ClientRank", tier)


def model_series(monthly: DataFrame, extra: DataFrame) -> DataFrame:
    """Company months and a second series stacked, with lags and means of the rows
    before the current one. Both inputs have one row per month."""
    both = monthly.select("YearMonth", F.col("label").cast("double").alias("label")).union(
        extra.select("YearMonth", F.col("label").cast("double"))
    )
    w = series_window([], "YearMonth")
    ordered = w.orderBy("YearMonth", "label")
    return both.select(
        "YearMonth",
        F.month("YearMonth").alias("month"),
        F.year("YearMonth").alias("year"),
        "label",
        F.lag("label", 1).over(ordered).alias("lag_1_month"),
        F.lag("label", 3).over(ordered).alias("lag_3_month"),
        F.avg("label").over(ordered.rowsBetween(-3, -1)).alias("rolling_mean_3m"),
        F.avg("label").over(ordered.rowsBetween(-6, -1)).alias("rolling_mean_6m"),
    ).filter("lag_3_month is not null")
