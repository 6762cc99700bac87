"""Business measures over the star schema, at any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions.scalars import repaired_category
from tarnlake.plans.gold import Star

VOLUME, LINES, COST, PROFIT = "SoldVolume", "LineTotalValue", "ProductionCost", "ProductProfit"
SUBTOTAL = "SubTotalValue"


def subtotal(orders: DataFrame, *by: str) -> DataFrame:
    """Order subtotals without counting an order twice: the largest per order, summed."""
    return (
        orders.groupBy(*by, "OrderID")
        .agg(F.max("SubTotal").alias("_one"))
        .groupBy(*by)
        .agg(F.sum("_one").alias(SUBTOTAL))
    )


def repaired_products(products: DataFrame) -> DataFrame:
    """Product levels as reports show them, unregistered ones as Miscellaneous."""
    return products.withColumns(
        {c: repaired_category("Category", "SubCategory", c) for c in ("Category", "SubCategory")}
    )


def _days(star: Star) -> DataFrame:
    return star["dim_date"].select(
        "DateKey", "FullDate", F.col("CalendarYear").alias("Year"),
        F.col("CalendarQuarter").alias("Quarter"), F.col("MonthNumberOfYear").alias("Month"),
        F.col("DayNumberOfMonth").alias("Day"), F.trunc("FullDate", "month").alias("MonthStart"),
    )


def dated(facts: DataFrame, star: Star) -> DataFrame:
    """Facts with an order date key, with the calendar's columns added."""
    return facts.join(_days(star), F.col("OrderDate_SK") == F.col("DateKey")).drop("DateKey")


def sold_lines(star: Star, dates: bool = False, places: bool = False, products: bool = True) -> DataFrame:
    """Sales lines with only the dimensions a report asks for.

    Unless all are asked for, lines are first summed per dimension key, so dimensions
    join sums. Every measure is linear in quantity and line total, so nothing changes.
    """
    lines = star["fact_sales_order_detail"].select("OrderID", "Product_SK", "OrderQty", "LineTotal")
    if dates or places:
        lines = lines.join(
            star["fact_sales_order"].select("OrderID", "OrderDate_SK", "Location_SK"), "OrderID"
        )
    asked = {"Product_SK": products, "OrderDate_SK": dates, "Location_SK": places}
    if not all(asked.values()):
        lines = lines.groupBy(*[k for k, on in asked.items() if on]).agg(
            F.sum("OrderQty").alias("OrderQty"), F.sum("LineTotal").alias("LineTotal")
        )
    if products:
        goods = repaired_products(star["dim_product"]).select(
            "Product_SK", "Category", "SubCategory", "ProductName", "StandardCost"
        )
        lines = lines.join(goods, "Product_SK")
    if dates:
        lines = dated(lines, star)
    if places:
        where = star["dim_location"].select(
            "Location_SK", F.col("CountryName").alias("Country"),
            F.col("StateProvinceName").alias("StateProvince"), "City",
        )
        lines = lines.join(where, "Location_SK")
    return lines


def line_measures(lines: DataFrame, *by: str) -> DataFrame:
    """Volume, line total, production cost and product profit."""
    sums = lines.groupBy(*by).agg(
        F.sum("OrderQty").cast("long").alias(VOLUME),
        F.sum("LineTotal").alias(LINES),
        F.sum(F.col("OrderQty") * F.col("StandardCost")).alias(COST),
    )
    return sums.withColumn(PROFIT, F.col(LINES) - F.col(COST))


def total_profit(star: Star, *by: str) -> DataFrame:
    """Sales line total less purchase subtotals on the calendar columns both share."""
    heads = dated(star["fact_sales_order"].select("OrderID", "OrderDate_SK"), star).select("OrderID", *by)
    sold = (
        star["fact_sales_order_detail"].select("OrderID", "LineTotal").join(heads, "OrderID")
        .groupBy(*by).agg(F.sum("LineTotal").alias(LINES))
    )
    bought = subtotal(
        dated(star["fact_purchases"].select("OrderID", "OrderDate_SK", "SubTotal"), star), *by
    )
    return sold.join(bought, list(by), "full_outer").select(
        *by,
        F.coalesce(LINES, F.lit(0)).alias(LINES),
        F.coalesce(SUBTOTAL, F.lit(0)).alias(SUBTOTAL),
    ).withColumn("TotalProfit", F.col(LINES) - F.col(SUBTOTAL))


def previous_month(monthly: DataFrame, month: str, measures: Sequence[str], *by: str) -> DataFrame:
    """Each measure's value one month earlier, null when that month is absent. Works on
    sums per month (and group), so its window is calendar-sized."""
    w = (Window.partitionBy(*by) if by else Window).orderBy(month)
    adjacent = F.lag(month).over(w) == F.add_months(month, -1)
    return monthly.withColumns(
        {f"{m}PreviousMonth": F.when(adjacent, F.lag(m).over(w)) for m in measures}
    )


def monthly_sales(star: Star) -> DataFrame:
    """Volume and order revenue per month with the month before."""
    heads = dated(star["fact_sales_order"].select("OrderID", "OrderDate_SK", "SubTotal"), star)
    volume = (
        star["fact_sales_order_detail"].select("OrderID", "OrderQty")
        .join(heads.select("OrderID", "MonthStart"), "OrderID")
        .groupBy("MonthStart").agg(F.sum("OrderQty").cast("long").alias(VOLUME))
    )
    both = volume.join(subtotal(heads, "MonthStart"), "MonthStart", "full_outer")
    return previous_month(both, "MonthStart", [VOLUME, SUBTOTAL])


def month_kpi(star: Star) -> DataFrame:
    """The newest month against the one before."""
    return (
        monthly_sales(star)
        .orderBy(F.desc("MonthStart"))
        .limit(1)
        .select(
            "MonthStart", VOLUME, f"{VOLUME}PreviousMonth", SUBTOTAL, f"{SUBTOTAL}PreviousMonth",
            (F.col(VOLUME) - F.col(f"{VOLUME}PreviousMonth")).alias("VolumeChange"),
            (F.col(SUBTOTAL) - F.col(f"{SUBTOTAL}PreviousMonth")).alias("RevenueChange"),
        )
    )


def drill_table(star: Star) -> DataFrame:
    """All line measures by day, quarter, product levels and place."""
    return line_measures(
        sold_lines(star, dates=True, places=True),
        "FullDate", "Quarter", "Category", "SubCategory", "ProductName", "Country",
        "StateProvince", "City",
    )


def rolled_up(lines: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Volume at every level of a hierarchy. Lines are summed at the deepest level
    first, so the rollup expands sums and not lines."""
    deepest = lines.groupBy(*levels).agg(F.sum("OrderQty").cast("long").alias("_v"))
    return deepest.rollup(*levels).agg(
        F.sum("_v").alias(VOLUME), F.grouping_id().cast("int").alias("Level")
    )


def product_drill(star: Star) -> DataFrame:
    return rolled_up(sold_lines(star), ("Category", "SubCategory", "ProductName"))


def date_drill(star: Star) -> DataFrame:
    return rolled_up(sold_lines(star, dates=True, products=False), ("Year", "Quarter", "Month", "Day"))


def place_drill(star: Star) -> DataFrame:
    return rolled_up(
        sold_lines(star, places=True, products=False), ("Country", "StateProvince", "City")
    )


def subcategory_table(star: Star) -> DataFrame:
    return line_measures(sold_lines(star), "SubCategory").orderBy(F.desc(VOLUME), "SubCategory")
