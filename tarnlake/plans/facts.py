"""Facts: cleaned rows with surrogate keys looked up, ready for the upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.dedup import dedup
from tarnlake.operators.lookup import lookup_sk
from tarnlake.operators.merge import scd1_merge
from tarnlake.sinks.ranges import Upsert, upsert_ranges

FACT_KEYS = {
    "fact_sales_order": ("OrderID",),
    "fact_sales_order_detail": ("SalesID",),
    "fact_purchases": ("PurchaseID",),
}


def fact_sales_order(headers: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order with its six keys; the latest shipped version of an order wins.

    Headers are reduced to one per order before the lookups: they keep every row, and
    the order uses only the two dates, whose keys rise with the dates. A date outside
    the calendar has key -1 and loses, as a missing date does.
    """
    calendar = dims["dim_date"]
    rows = headers.select(
        F.col("SalesOrderID").alias("OrderID"), "ShipToAddressID", "CustomerID", "CurrencyRateID",
        "TerritoryID", F.to_date("OrderDate").alias("_od"), F.to_date("ShipDate").alias("_sd"),
        "SubTotal", F.col("Freight").alias("ShippingCost"), "TaxAmt",
    )
    rows = lookup_sk(rows, calendar, "_od", "FullDate", "DateKey", "OrderDate_SK")
    rows = lookup_sk(rows, calendar, "_sd", "FullDate", "DateKey", "ShipDate_SK")
    rows = dedup(rows, ["OrderID"], ["ShipDate_SK desc", "OrderDate_SK desc"])
    rows = lookup_sk(rows, dims["dim_customer"], "CustomerID", "CustomerID", "Customer_SK", "Customer_SK")
    rows = lookup_sk(rows, dims["dim_currency"], "CurrencyRateID", "CurrencyRateID", "Currency_SK", "Currency_SK")
    rows = lookup_sk(rows, dims["dim_location"], "ShipToAddressID", "AddressID", "Location_SK", "Location_SK")
    rows = lookup_sk(rows, dims["dim_territory"], "TerritoryID", "TerritoryID", "Territory_SK", "Territory_SK")
    return rows.select(
        "OrderID", "ShipToAddressID", "Customer_SK", "OrderDate_SK", "ShipDate_SK", "Currency_SK",
        "Location_SK", "Territory_SK", "SubTotal", "ShippingCost", "TaxAmt",
    )


def fact_sales_order_detail(lines: DataFrame, products: DataFrame) -> DataFrame:
    rows = lines.select(
        F.col("SalesOrderDetailID").alias("SalesID"), F.col("SalesOrderID").alias("OrderID"),
        "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
    )
    return lookup_sk(rows, products, "ProductID", "ProductID", "Product_SK", "Product_SK").select(
        "SalesID", "OrderID", "Product_SK", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal"
    )


def fact_purchases(lines: DataFrame, headers: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Purchase lines of known orders; order amounts are repeated on each line. Header
    keys are looked up before the lines multiply them."""
    calendar = dims["dim_date"]
    heads = headers.select(
        "PurchaseOrderID", "VendorID", F.to_date("OrderDate").alias("_od"),
        F.to_date("ShipDate").alias("_sd"), "SubTotal", F.col("TaxAmount").alias("TaxAmt"),
        F.col("Freight").alias("ShippingCost"), "TotalDue",
    )
    heads = lookup_sk(heads, dims["dim_supplier"], "VendorID", "SupplierID", "Supplier_SK", "Supplier_SK")
    heads = lookup_sk(heads, calendar, "_od", "FullDate", "DateKey", "OrderDate_SK")
    heads = lookup_sk(heads, calendar, "_sd", "FullDate", "DateKey", "ShipDate_SK")
    rows = lines.drop("DueDate").join(heads, "PurchaseOrderID")
    rows = lookup_sk(rows, dims["dim_product"], "ProductID", "ProductID", "Product_SK", "Product_SK")
    return rows.select(
        F.col("PurchaseOrderDetailID").alias("PurchaseID"), F.col("PurchaseOrderID").alias("OrderID"),
        "Product_SK", "Supplier_SK", "OrderDate_SK", "ShipDate_SK",
        F.col("OrderQuantity").alias("OrderQty"), "ReceivedQuantity", "RejectedQuantity",
        "StockedQuantity", "UnitPrice", "LineTotal", "SubTotal", "TaxAmt", "ShippingCost", "TotalDue",
    )


def upsert_fact(name: str, source: DataFrame, path: str, staged: bool = False) -> Upsert:
    """Merge rows into a fact stored in files of key ranges; returns what was read and the rows that changed."""
    keys = FACT_KEYS[name]
    return upsert_ranges(source, path, keys, [c for c in source.columns if c not in keys], staged)


def load_fact(name: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """Next version of a fact; every written column is also compared."""
    keys = FACT_KEYS[name]
    return scd1_merge(target, source, keys, [c for c in source.columns if c not in keys])
