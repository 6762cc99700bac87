"""Business measures and report tables."""

from __future__ import annotations

from collections.abc import Callable

from checks.common import Registry, m, tidy
from checks.mapping import Tables, with_tables
from tarnlake.plans import measures as ms

SQL = {
    "product_levels": """
        SELECT Product_SK, ProductID, ProductName, StandardCost,
          CASE WHEN (Category = 'Not registered' AND SubCategory = 'Not registered') OR Category IS NULL
            THEN 'Miscellaneous' ELSE Category END AS Category,
          CASE WHEN (Category = 'Not registered' AND SubCategory = 'Not registered') OR SubCategory IS NULL
            THEN 'Miscellaneous' ELSE SubCategory END AS SubCategory FROM dim_product""",
    "sold": """
        SELECT s.OrderID, OrderQty, LineTotal, OrderQty * StandardCost AS LineCost, Category, SubCategory, ProductName,
          FullDate, CalendarYear AS Year, CalendarQuarter AS Quarter, MonthNumberOfYear AS Month,
          DayNumberOfMonth AS Day, date_trunc('month', FullDate)::DATE AS MonthStart, CountryName AS Country,
          StateProvinceName AS StateProvince, City
        FROM fact_sales_order_detail s JOIN fact_sales_order o ON s.OrderID = o.OrderID
          JOIN product_levels p ON s.Product_SK = p.Product_SK JOIN dim_date ON o.OrderDate_SK = DateKey
          JOIN dim_location l ON o.Location_SK = l.Location_SK""",
    "sold_products": """
        SELECT OrderQty, LineTotal, OrderQty * StandardCost AS LineCost, Category, SubCategory, ProductName
        FROM fact_sales_order_detail s JOIN product_levels p ON s.Product_SK = p.Product_SK""",
    "sold_places": """
        SELECT OrderQty, CountryName AS Country, StateProvinceName AS StateProvince, City
        FROM fact_sales_order_detail s JOIN fact_sales_order o ON s.OrderID = o.OrderID
          JOIN dim_location l ON o.Location_SK = l.Location_SK""",
    "months": """
        SELECT v.MonthStart, SoldVolume, SubTotalValue,
          (SELECT p.SoldVolume FROM volumes p WHERE p.MonthStart = v.MonthStart - INTERVAL 1 MONTH) AS SoldVolumePreviousMonth,
          (SELECT p.SubTotalValue FROM revenues p WHERE p.MonthStart = v.MonthStart - INTERVAL 1 MONTH) AS SubTotalValuePreviousMonth
        FROM volumes v FULL JOIN revenues r ON v.MonthStart = r.MonthStart""",
    "volumes": "SELECT MonthStart, sum(OrderQty)::BIGINT AS SoldVolume FROM sold GROUP BY ALL",
    "revenues": """
        SELECT date_trunc('month', FullDate)::DATE AS MonthStart, sum(SubTotal) AS SubTotalValue
        FROM fact_sales_order JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL""",
}
_LINES = (
    f"sum(OrderQty)::BIGINT AS SoldVolume, {m('sum(LineTotal)', 'LineTotalValue')}, "
    f"{m('sum(LineCost)', 'ProductionCost')}, {m('sum(LineTotal) - sum(LineCost)', 'ProductProfit')}"
)


def _rollup(levels: str, source: str = "sold") -> str:
    return f"""SELECT {levels}, sum(OrderQty)::BIGINT AS SoldVolume, CAST(grouping_id({levels}) AS INT) AS Level
               FROM {source} GROUP BY ROLLUP ({levels})"""


def register(reg: Registry) -> None:
    def add(name: str, build: Callable, sql: str) -> None:
        reg.add(name, lambda s, d, b=build: tidy(b(Tables(s, d))), with_tables(sql, SQL))

    add("i01_sales_subtotal", lambda t: ms.subtotal(ms.dated(t["fact_sales_order"], t), "Year"),
        f"""SELECT CalendarYear AS Year, {m('sum(SubTotal)', 'SubTotalValue')}
            FROM fact_sales_order JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL""")
    add("i02_purchase_subtotal", lambda t: ms.subtotal(ms.dated(t["fact_purchases"], t), "Year", "Month"),
        f"""SELECT Year, Month, {m('sum(one)', 'SubTotalValue')} FROM (
              SELECT CalendarYear AS Year, MonthNumberOfYear AS Month, OrderID, max(SubTotal) AS one
              FROM fact_purchases JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL) AS g GROUP BY ALL""")
    add("i03_line_totals", lambda t: ms.line_measures(ms.sold_lines(t, dates=True), "Year").select("Year", ms.LINES, ms.VOLUME),
        f"SELECT Year, {m('sum(LineTotal)', 'LineTotalValue')}, sum(OrderQty)::BIGINT AS SoldVolume FROM sold GROUP BY ALL")
    add("i04_total_profit", lambda t: ms.total_profit(t, "Year", "Month"),
        f"""SELECT coalesce(s.Year, p.Year) AS Year, coalesce(s.Month, p.Month) AS Month, {m('coalesce(v, 0)', 'LineTotalValue')},
              {m('coalesce(c, 0)', 'SubTotalValue')}, {m('coalesce(v, 0) - coalesce(c, 0)', 'TotalProfit')}
            FROM (SELECT Year, Month, sum(LineTotal) AS v FROM sold GROUP BY ALL) AS s
              FULL JOIN (SELECT Year, Month, sum(one) AS c FROM (
                SELECT CalendarYear AS Year, MonthNumberOfYear AS Month, OrderID, max(SubTotal) AS one
                FROM fact_purchases JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL) AS g GROUP BY ALL) AS p
              ON s.Year = p.Year AND s.Month = p.Month""")
    add("i05_production_cost", lambda t: ms.line_measures(ms.sold_lines(t), "ProductName"),
        f"SELECT ProductName, {_LINES} FROM sold_products GROUP BY ALL")
    add("i06_previous_month", ms.monthly_sales,
        f"""SELECT MonthStart, SoldVolume, {m('SubTotalValue')}, SoldVolumePreviousMonth,
              {m('SubTotalValuePreviousMonth')} FROM months""")
    add("i07_repaired_categories",
        lambda t: ms.repaired_products(t["dim_product"]).select("ProductID", "Category", "SubCategory"),
        "SELECT ProductID, Category, SubCategory FROM product_levels")
    add("i08_drill_table", ms.drill_table,
        f"""SELECT FullDate, Quarter, Category, SubCategory, ProductName, Country, StateProvince, City, {_LINES}
            FROM sold GROUP BY ALL""")
    add("i09_product_drill", ms.product_drill, _rollup("Category, SubCategory, ProductName", "sold_products"))
    add("i09_date_drill", ms.date_drill, _rollup("Year, Quarter, Month, Day"))
    add("i10_place_drill", ms.place_drill, _rollup("Country, StateProvince, City", "sold_places"))
    add("i11_subcategory_table", ms.subcategory_table, f"SELECT SubCategory, {_LINES} FROM sold_products GROUP BY ALL")
    add("i12_month_kpi", ms.month_kpi,
        f"""SELECT MonthStart, SoldVolume, SoldVolumePreviousMonth, {m('SubTotalValue')}, {m('SubTotalValuePreviousMonth')},
              SoldVolume - SoldVolumePreviousMonth AS VolumeChange,
              {m('SubTotalValue - SubTotalValuePreviousMonth', 'RevenueChange')}
            FROM months ORDER BY MonthStart DESC LIMIT 1""")
