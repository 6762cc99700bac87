"""Profitability, purchases and sales views, and the dashboard queries over them.

``star`` maps table names to DataFrames. Joins follow keys and carry no hints: the
optimizer broadcasts what it measures as small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.scalars import margin, profit_status, ratio, short_name
from tarnlake.session import checkpointed

Star = Mapping[str, DataFrame]

PROFIT_GRAIN = (
    "OrderDate", "Year", "Month", "MonthName", "ProductID", "ProductName", "Category",
    "SubCategory", "Country", "StateProvince", "Currency", "SalesTerritory", "TerritoryGroup",
)


ORDER_KEYS = ("OrderDate_SK", "Location_SK", "Currency_SK", "Territory_SK")


def key_sums(star: Star) -> DataFrame:
    """Quantity and amount per combination of the keys that the views look up."""
    return (
        star["fact_sales_order_detail"]
        .select("OrderID", "Product_SK", "OrderQty", "LineTotal")
        .join(star["fact_sales_order"].select("OrderID", *ORDER_KEYS), "OrderID")
        .groupBy("Product_SK", *ORDER_KEYS)
        .agg(F.sum("OrderQty").alias("OrderQty"), F.sum("LineTotal").alias("LineTotal"))
    )


def profit_sums(star: Star, sums: DataFrame | None = None) -> DataFrame:
    """Revenue and cost with every attribute the views group by.

    Lines meet only their order's integer keys and are summed per key combination, or such ``sums`` are kept up to date
    elsewhere; names join the sums. Both measures are linear in the summed columns, so nothing changes.
    """
    return (
        (key_sums(star) if sums is None else sums)
        .join(star["dim_location"].select("Location_SK", "CountryName", "StateProvinceName"), "Location_SK")
        .join(star["dim_product"], "Product_SK")
        .join(star["dim_date"], F.col("OrderDate_SK") == F.col("DateKey"))
        .join(star["dim_currency"], "Currency_SK")
        .join(star["dim_territory"], "Territory_SK")
        .select(
            F.col("FullDate").alias("OrderDate"),
            F.col("CalendarYear").alias("Year"),
            F.col("MonthNumberOfYear").alias("Month"),
            "MonthName", "ProductID", "ProductName", "Category", "SubCategory",
            F.col("CountryName").alias("Country"),
            F.col("StateProvinceName").alias("StateProvince"),
            F.col("ToCurrencyCode").alias("Currency"),
            F.col("TerritoryName").alias("SalesTerritory"),
            "TerritoryGroup",
            F.col("LineTotal").alias("LineRevenue"),
            (F.col("OrderQty") * F.col("StandardCost")).alias("LineCost"),
        )
    )


def profitability(star: Star, sums: DataFrame | None = None) -> DataFrame:
    sums = profit_sums(star, sums).groupBy(*PROFIT_GRAIN).agg(
        F.sum("LineRevenue").alias("Revenue"), F.sum("LineCost").alias("Cost")
    )
    return sums.withColumn("Profit", F.col("Revenue") - F.col("Cost")).select(
        *PROFIT_GRAIN,
        "Revenue", "Cost", "Profit",
        margin("Revenue", "Cost").alias("ProfitMargin"),
        profit_status("Profit").alias("ProfitabilityStatus"),
    )


def yearly_totals(star: Star) -> DataFrame:
    """Revenue and cost per product and year, over the lines the profitability view has.

    Lines are summed per product key before the product joins, and the other dimensions
    only have to know an order's keys. The result is stored once: the newest year is
    looked up in it and it is then filtered, and the line join must not run twice for that.
    """
    orders = star["fact_sales_order"].join(
        star["dim_date"].select("DateKey", F.col("CalendarYear").alias("Year")),
        F.col("OrderDate_SK") == F.col("DateKey"),
    )
    for dim, key in (("dim_location", "Location_SK"), ("dim_currency", "Currency_SK"), ("dim_territory", "Territory_SK")):
        orders = orders.join(star[dim].select(key), key, "left_semi")
    sums = (
        star["fact_sales_order_detail"]
        .select("OrderID", "Product_SK", "OrderQty", "LineTotal")
        .join(orders.select("OrderID", "Year"), "OrderID")
        .groupBy("Product_SK", "Year")
        .agg(F.sum("LineTotal").alias("_v"), F.sum("OrderQty").alias("_q"))
        .join(star["dim_product"].select("Product_SK", "ProductName", "StandardCost"), "Product_SK")
        .groupBy("ProductName", "Year")
        .agg(F.sum("_v").alias("Revenue"), F.sum(F.col("_q") * F.col("StandardCost")).alias("Cost"))
    )
    return checkpointed(sums)


def recent_years(df: DataFrame, years: int = 2) -> DataFrame:
    """Rows of the last ``years`` years present in the data."""
    newest = df.agg(F.max("Year")).scalar()
    return df.filter(F.col("Year") > newest - years)


def revenue_against_cost(star: Star, top: int = 10) -> DataFrame:
    """Best sellers of the last two years."""
    return (
        recent_years(yearly_totals(star))
        .groupBy("ProductName")
        .agg(F.sum("Revenue").alias("TotalRevenue"), F.sum("Cost").alias("TotalCost"))
        .select("ProductName", short_name("ProductName").alias("ProductShortName"), "TotalRevenue", "TotalCost")
        .orderBy(F.desc("TotalRevenue"), "ProductName")
        .limit(top)
    )


def loss_makers(profit: DataFrame, worst: int = 10) -> DataFrame:
    """Product and country groups with a negative mean margin, worst first."""
    keys = ("ProductName", "Category", "SubCategory", "Country")
    return (
        profit.groupBy(*keys)
        .agg(
            *[F.sum(c).alias(c) for c in ("Revenue", "Cost", "Profit")],
            F.avg("ProfitMargin").alias("AvgProfitMargin"),
        )
        .filter("AvgProfitMargin < 0")
        .orderBy("AvgProfitMargin", *keys)
        .limit(worst)
    )


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def purchases_for_bi(star: Star) -> DataFrame:
    """Purchases per order and day: freight and tax are variable, the rest fixed."""
    return (
        star["fact_purchases"]
        .join(star["dim_date"].select("DateKey", "FullDate"), F.col("OrderDate_SK") == F.col("DateKey"))
        .groupBy("OrderID", "FullDate")
        .agg(
            _money(F.sum("LineTotal")).alias("Purchases"),
            (_money(F.max("ShippingCost")) + _money(F.max("TaxAmt"))).alias("Variable_Costs"),
        )
        .select(
            "OrderID", "Purchases", "Variable_Costs",
            _money(F.col("Purchases") - F.col("Variable_Costs")).alias("Fixed_Costs"),
            F.date_format("FullDate", "yyyy-MM-dd").alias("FullDate"),
        )
    )


def sales_for_bi(star: Star) -> DataFrame:
    """Sales per order with its day and customer; readers sort what they show."""
    heads = (
        star["fact_sales_order"]
        .join(star["dim_customer"].select("Customer_SK", "PersonName"), "Customer_SK")
        .join(star["dim_date"].select("DateKey", "FullDate"), F.col("OrderDate_SK") == F.col("DateKey"))
        .select("OrderID", "ShippingCost", "TaxAmt", "FullDate", F.col("PersonName").alias("Customer"))
    )
    return (
        star["fact_sales_order_detail"]
        .join(heads, "OrderID")
        .groupBy("OrderID", "FullDate", "Customer")
        .agg(
            _money(F.sum("LineTotal")).alias("Sales"),
            _money(F.max("ShippingCost")).alias("ShippingCost"),
            _money(F.max("TaxAmt")).alias("TaxAmount"),
        )
        .withColumn("FullDate", F.date_format("FullDate", "yyyy-MM-dd"))
    )


# Dashboard queries over the profitability view.


def kpi_totals(profit: DataFrame) -> DataFrame:
    return profit.agg(
        F.sum("Revenue").alias("TotalRevenue"),
        F.sum("Cost").alias("TotalCost"),
        F.sum("Profit").alias("TotalProfit"),
        F.avg("ProfitMargin").alias("AvgProfitMargin"),
    )


def monthly_by_country(profit: DataFrame, measure: str) -> DataFrame:
    month = F.trunc("OrderDate", "month")
    return profit.groupBy(month.alias("OrderMonth"), "Country").agg(F.sum(measure).alias(measure))


def mean_margin_by(profit: DataFrame, *by: str) -> DataFrame:
    return profit.groupBy(*by).agg(F.avg("ProfitMargin").alias("AvgProfitMargin"))


def totals_by_short_name(top: DataFrame) -> DataFrame:
    return top.groupBy("ProductShortName").agg(
        F.sum("TotalRevenue").alias("TotalRevenue"), F.sum("TotalCost").alias("TotalCost")
    )


def filter_values(profit: DataFrame, field: str, condition: Column | None = None) -> DataFrame:
    """Values of a filter field with the rows each matches under the other filters."""
    hit = F.lit(True) if condition is None else condition
    return profit.groupBy(field).agg(F.count_if(hit).alias("Matches"))


def loss_alert(star: Star) -> DataFrame:
    """Products that lost money over the latest year."""
    lost = recent_years(yearly_totals(star), 1).withColumn("Margin", ratio(F.col("Revenue") - F.col("Cost"), "Revenue"))
    return lost.filter("Margin < 0").select("ProductName", "Year", "Revenue", "Cost", "Margin")


def alert_fires(lost: DataFrame) -> DataFrame:
    return lost.agg(F.count(F.lit(1)).alias("LossProducts")).withColumn(
        "Alert", F.col("LossProducts") > 0
    )


def filtered(profit: DataFrame, **choices: Sequence[object]) -> DataFrame:
    """Apply the dashboard's filter boxes (field = accepted values)."""
    for field, values in choices.items():
        profit = profit.filter(F.col(field).isin(*values))
    return profit
