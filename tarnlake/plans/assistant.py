"""Flat views for question answering over sales, purchases, customers and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.plans.gold import Star


def _dated(df: DataFrame, star: Star, *parts: str) -> DataFrame:
    days = star["dim_date"].select(
        "DateKey", "FullDate", F.col("CalendarYear").alias("Year"),
        F.col("MonthNumberOfYear").alias("Month"),
    ).select("DateKey", *parts)
    return df.join(days, F.col("OrderDate_SK") == F.col("DateKey"), "left").drop("DateKey")


def _row_total():
    return F.col("SubTotal") + F.col("TaxAmt") + F.col("ShippingCost")


def _revenue_columns():
    return [
        F.col("SubTotal").alias("ProductRevenue"),
        F.col("TaxAmt").alias("TaxAmount"),
        F.col("ShippingCost").alias("ShippingAmount"),
        _row_total().alias("TotalRevenue"),
    ]


def customer_view(star: Star) -> DataFrame:
    people = star["dim_customer"].select(
        "Customer_SK", "CustomerID", "CustomerType", "PersonName", "StoreName"
    )
    rows = _dated(star["fact_sales_order"], star, "FullDate", "Year", "Month")
    return rows.join(people, "Customer_SK", "left").select(
        "OrderID", "Customer_SK", "FullDate", "Year", "Month", "CustomerID", "CustomerType",
        "PersonName", "StoreName", *_revenue_columns(),
    )


def product_view(star: Star) -> DataFrame:
    goods = star["dim_product"].select("Product_SK", "ProductName", "Category", "SubCategory")
    orders = _dated(
        star["fact_sales_order"].select("OrderID", "OrderDate_SK"), star, "Year", "Month"
    )
    return (
        star["fact_sales_order_detail"]
        .join(goods, "Product_SK", "left")
        .join(orders, "OrderID", "left")
        .select(
            "OrderID", "Product_SK", "ProductName", "Category", "SubCategory", "Year", "Month",
            "OrderQty", F.col("LineTotal").alias("SalesAmount"),
        )
    )


def purchases_view(star: Star) -> DataFrame:
    return _dated(star["fact_purchases"], star, "Year", "Month").select(
        "Product_SK", "Supplier_SK", "Year", "Month", "OrderQty", "ReceivedQuantity",
        "LineTotal", "TotalDue",
    )


def region_view(star: Star) -> DataFrame:
    places = star["dim_location"].select("Location_SK", "City", "StateProvinceName", "CountryName")
    regions = star["dim_territory"].select(
        "Territory_SK", "TerritoryName", "TerritoryGroup", "CountryRegionCode"
    )
    rows = _dated(star["fact_sales_order"], star, "FullDate", "Year", "Month")
    return (
        rows.join(regions, "Territory_SK", "left")
        .join(places, "Location_SK", "left")
        .select(
            "OrderID", "Customer_SK", "FullDate", "Year", "Month", "TerritoryName",
            "TerritoryGroup", "CountryRegionCode", "City", "StateProvinceName", "CountryName",
            *_revenue_columns(),
        )
    )


def sales_view(star: Star) -> DataFrame:
    return _dated(star["fact_sales_order"], star, "FullDate", "Year", "Month").select(
        "OrderID", "Customer_SK", "Territory_SK", "FullDate", "Year", "Month",
        F.col("SubTotal").alias("Sales_SubTotal"), F.col("TaxAmt").alias("Sales_Tax"),
        "ShippingCost", _row_total().alias("Sales_Total"),
    )
