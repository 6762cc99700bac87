"""Gold, assistant and dashboard queries on the star mapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from checks.common import Registry, m, q, tidy
from checks.mapping import Tables, with_tables
from tarnlake.plans import assistant, gold

SQL = {
    "profit_lines": """
        SELECT d.FullDate AS OrderDate, d.CalendarYear AS Year, d.MonthNumberOfYear AS Month, d.MonthName,
          p.ProductID, p.ProductName, p.Category, p.SubCategory, l.CountryName AS Country,
          l.StateProvinceName AS StateProvince, c.ToCurrencyCode AS Currency,
          t.TerritoryName AS SalesTerritory, t.TerritoryGroup, s.LineTotal,
          s.OrderQty * p.StandardCost AS LineCost
        FROM fact_sales_order_detail s JOIN fact_sales_order o ON s.OrderID = o.OrderID
          JOIN dim_product p ON s.Product_SK = p.Product_SK
          JOIN dim_date d ON o.OrderDate_SK = d.DateKey
          JOIN dim_location l ON o.Location_SK = l.Location_SK
          JOIN dim_currency c ON o.Currency_SK = c.Currency_SK
          JOIN dim_territory t ON o.Territory_SK = t.Territory_SK""",
    "profitability": f"""
        SELECT {', '.join(gold.PROFIT_GRAIN)}, sum(LineTotal) AS Revenue, sum(LineCost) AS Cost,
          sum(LineTotal) - sum(LineCost) AS Profit,
          CASE WHEN sum(LineTotal) = 0 THEN 0 ELSE CAST(sum(LineTotal) - sum(LineCost) AS DOUBLE)
            / CAST(sum(LineTotal) AS DOUBLE) END AS ProfitMargin,
          CASE WHEN sum(LineTotal) < sum(LineCost) THEN 'Not Profitable' ELSE 'Profitable' END AS ProfitabilityStatus
        FROM profit_lines GROUP BY {', '.join(gold.PROFIT_GRAIN)}""",
    "best_sellers": """
        SELECT ProductName, upper(left(ProductName, 1)) || regexp_extract(ProductName, '(\\d+)', 1) || '-'
            || regexp_extract(ProductName, '(\\d+)$', 1) AS ProductShortName,
          sum(Revenue) AS TotalRevenue, sum(Cost) AS TotalCost
        FROM profitability WHERE Year >= (SELECT max(Year) - 1 FROM profitability)
        GROUP BY ProductName ORDER BY TotalRevenue DESC, ProductName LIMIT 10""",
    "loss_groups": """
        SELECT ProductName, Category, SubCategory, Country, sum(Revenue) AS Revenue, sum(Cost) AS Cost,
          sum(Profit) AS Profit, avg(ProfitMargin) AS AvgProfitMargin
        FROM profitability GROUP BY ALL HAVING avg(ProfitMargin) < 0""",
    "lost_products": """
        SELECT ProductName, Year, sum(Revenue) AS Revenue, sum(Cost) AS Cost,
          CAST(sum(Profit) AS DOUBLE) / CAST(sum(Revenue) AS DOUBLE) AS Margin
        FROM profitability WHERE Year = (SELECT max(Year) FROM profitability)
        GROUP BY ProductName, Year HAVING sum(Profit) / sum(Revenue) < 0""",
}

_COUNTRY_MONTHS = "SELECT date_trunc('month', OrderDate)::DATE AS OrderMonth, Country, {} FROM profitability GROUP BY ALL"
_AMOUNTS = f"{m('SubTotal', 'ProductRevenue')}, {m('TaxAmt', 'TaxAmount')}, {m('ShippingCost', 'ShippingAmount')}, {m('SubTotal + TaxAmt + ShippingCost', 'TotalRevenue')}"


def register(reg: Registry) -> None:
    def add(name: str, build: Callable, sql: str) -> None:
        reg.add(name, lambda s, d, b=build: tidy(b(Tables(s, d))), with_tables(sql, SQL))

    prof = gold.profitability
    add("f01_profitability", prof,
        f"SELECT {', '.join(gold.PROFIT_GRAIN)}, {m('Revenue')}, {m('Cost')}, {m('Profit')}, "
        f"{q('ProfitMargin', 'ProfitMargin')}, ProfitabilityStatus FROM profitability")
    add("f02_revenue_against_cost", gold.revenue_against_cost,
        f"SELECT ProductName, ProductShortName, {m('TotalRevenue')}, {m('TotalCost')} FROM best_sellers")
    add("f03_loss_makers", lambda t: gold.loss_makers(prof(t)),
        f"SELECT ProductName, Category, SubCategory, Country, {m('Revenue')}, {m('Cost')}, {m('Profit')}, "
        f"{q('AvgProfitMargin', 'AvgProfitMargin')} FROM (SELECT * FROM loss_groups ORDER BY AvgProfitMargin, "
        "ProductName, Category, SubCategory, Country LIMIT 10) AS w")
    add("f04_purchases_for_bi", gold.purchases_for_bi,
        f"""SELECT OrderID, {m('Purchases')}, {m('Variable_Costs')},
              {m('CAST(Purchases - Variable_Costs AS DECIMAL(18,2))', 'Fixed_Costs')}, FullDate FROM (
            SELECT OrderID, strftime(FullDate, '%Y-%m-%d') AS FullDate,
              CAST(sum(LineTotal) AS DECIMAL(18,2)) AS Purchases,
              CAST(max(ShippingCost) AS DECIMAL(18,2)) + CAST(max(TaxAmt) AS DECIMAL(18,2)) AS Variable_Costs
            FROM fact_purchases JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL) AS g""")
    add("f05_sales_for_bi", gold.sales_for_bi,
        f"""SELECT s.OrderID, {m('CAST(sum(LineTotal) AS DECIMAL(18,2))', 'Sales')},
              {m('CAST(max(ShippingCost) AS DECIMAL(18,2))', 'ShippingCost')},
              {m('CAST(max(TaxAmt) AS DECIMAL(18,2))', 'TaxAmount')},
              strftime(FullDate, '%Y-%m-%d') AS FullDate, PersonName AS Customer
            FROM fact_sales_order_detail s JOIN fact_sales_order o ON s.OrderID = o.OrderID
              JOIN dim_customer c ON o.Customer_SK = c.Customer_SK JOIN dim_date ON OrderDate_SK = DateKey
            GROUP BY s.OrderID, FullDate, PersonName""")
    add("f06_customer_view", assistant.customer_view,
        f"""SELECT OrderID, o.Customer_SK, FullDate, CalendarYear AS Year, MonthNumberOfYear AS Month,
              CustomerID, CustomerType, PersonName, StoreName, {_AMOUNTS}
            FROM fact_sales_order o LEFT JOIN dim_customer c ON o.Customer_SK = c.Customer_SK
              LEFT JOIN dim_date ON OrderDate_SK = DateKey""")
    add("f07_product_view", assistant.product_view,
        f"""SELECT s.OrderID, s.Product_SK, ProductName, Category, SubCategory, CalendarYear AS Year,
              MonthNumberOfYear AS Month, OrderQty, {m('LineTotal', 'SalesAmount')}
            FROM fact_sales_order_detail s LEFT JOIN dim_product p ON s.Product_SK = p.Product_SK
              LEFT JOIN fact_sales_order o ON s.OrderID = o.OrderID LEFT JOIN dim_date ON OrderDate_SK = DateKey""")
    add("f08_purchases_view", assistant.purchases_view,
        f"""SELECT Product_SK, Supplier_SK, CalendarYear AS Year, MonthNumberOfYear AS Month, OrderQty,
              ReceivedQuantity, {m('LineTotal')}, {m('TotalDue')}
            FROM fact_purchases LEFT JOIN dim_date ON OrderDate_SK = DateKey""")
    add("f09_region_view", assistant.region_view,
        f"""SELECT OrderID, Customer_SK, FullDate, CalendarYear AS Year, MonthNumberOfYear AS Month,
              TerritoryName, TerritoryGroup, CountryRegionCode, City, StateProvinceName, CountryName, {_AMOUNTS}
            FROM fact_sales_order o LEFT JOIN dim_date ON OrderDate_SK = DateKey
              LEFT JOIN dim_territory t ON o.Territory_SK = t.Territory_SK
              LEFT JOIN dim_location l ON o.Location_SK = l.Location_SK""")
    add("f10_sales_view", assistant.sales_view,
        f"""SELECT OrderID, Customer_SK, Territory_SK, FullDate, CalendarYear AS Year, MonthNumberOfYear AS Month,
              {m('SubTotal', 'Sales_SubTotal')}, {m('TaxAmt', 'Sales_Tax')}, {m('ShippingCost')},
              {m('SubTotal + TaxAmt + ShippingCost', 'Sales_Total')}
            FROM fact_sales_order LEFT JOIN dim_date ON OrderDate_SK = DateKey""")
    add("f11_kpi_totals", lambda t: gold.kpi_totals(prof(t)),
        f"""SELECT {m('sum(Revenue)', 'TotalRevenue')}, {m('sum(Cost)', 'TotalCost')},
              {m('sum(Profit)', 'TotalProfit')}, {q('avg(ProfitMargin)', 'AvgProfitMargin')} FROM profitability""")
    add("f12_monthly_revenue_by_country", lambda t: gold.monthly_by_country(prof(t), "Revenue"),
        _COUNTRY_MONTHS.format(m("sum(Revenue)", "Revenue")))
    add("f13_monthly_profit_by_country", lambda t: gold.monthly_by_country(prof(t), "Profit"),
        _COUNTRY_MONTHS.format(m("sum(Profit)", "Profit")))
    add("f14_margin_by_territory", lambda t: gold.mean_margin_by(prof(t), "SalesTerritory"),
        f"SELECT SalesTerritory, {q('avg(ProfitMargin)', 'AvgProfitMargin')} FROM profitability GROUP BY ALL")
    add("f15_margin_by_category", lambda t: gold.mean_margin_by(prof(t), "Category"),
        f"SELECT Category, {q('avg(ProfitMargin)', 'AvgProfitMargin')} FROM profitability GROUP BY ALL")
    add("f16_totals_by_short_name", lambda t: gold.totals_by_short_name(gold.revenue_against_cost(t)),
        f"""SELECT ProductShortName, {m('sum(TotalRevenue)', 'TotalRevenue')}, {m('sum(TotalCost)', 'TotalCost')}
            FROM best_sellers GROUP BY ALL""")
    add("f17_filter_years", lambda t: gold.filter_values(prof(t), "Year", F.col("TerritoryGroup") == "East"),
        "SELECT Year, count_if(TerritoryGroup = 'East')::BIGINT AS Matches FROM profitability GROUP BY ALL")
    add("f17_filter_territory_groups",
        lambda t: gold.filter_values(prof(t), "TerritoryGroup", F.col("Year") == 1998),
        "SELECT TerritoryGroup, count_if(Year = 1998)::BIGINT AS Matches FROM profitability GROUP BY ALL")
    add("f18_loss_alert", gold.loss_alert,
        f"SELECT ProductName, Year, {m('Revenue')}, {m('Cost')}, {q('Margin', 'Margin')} FROM lost_products")
    add("f18_alert_fires", lambda t: gold.alert_fires(gold.loss_alert(t)),
        "SELECT count(*) AS LossProducts, count(*) > 0 AS Alert FROM lost_products")
