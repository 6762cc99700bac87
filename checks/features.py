"""Feature tables. The SQL side uses calendar joins and interval frames throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from checks.common import Registry, m, q, tidy
from checks.mapping import Tables, with_tables
from tarnlake.operators import timeseries as ts
from tarnlake.plans import features

_P = "PARTITION BY Product_SK ORDER BY ReferenceDate"
_C = "PARTITION BY Customer_SK ORDER BY ReferenceDate"
_T = "PARTITION BY Territory_SK ORDER BY ReferenceDate"


def frame(n: int) -> str:
    return f"RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW"


def growth(cur: str, prev: str) -> str:
    return (
        f"CASE WHEN {prev} IS NULL OR {prev} = 0 THEN 0.0 ELSE (CAST({cur} AS DOUBLE) - "
        f"CAST({prev} AS DOUBLE)) / CAST({prev} AS DOUBLE) END"
    )


def since(day: str, event: str) -> str:
    return f"coalesce(date_diff('day', {event}, {day}), 999)::INT"


_SPANS, _STEPS = (7, 30, 90, 365), (1, 7, 30, 90, 365)
SQL = {
    "dated_lines": """
        SELECT o.Customer_SK, o.Territory_SK, s.Product_SK, s.OrderID, FullDate AS ReferenceDate, s.OrderQty,
          s.LineTotal, o.SubTotal
        FROM fact_sales_order_detail s JOIN fact_sales_order o ON s.OrderID = o.OrderID
          JOIN dim_date ON o.OrderDate_SK = DateKey""",
    "daily_product": """
        SELECT Product_SK, ReferenceDate, sum(OrderQty)::BIGINT AS DailyQty FROM dated_lines GROUP BY ALL""",
    "dense_product": """
        SELECT r.Product_SK, FullDate AS ReferenceDate, coalesce(DailyQty, 0) AS DailyQty
        FROM (SELECT Product_SK, min(ReferenceDate) AS a, max(ReferenceDate) AS b FROM daily_product GROUP BY ALL) AS r
          JOIN dim_date ON FullDate BETWEEN a AND b
          LEFT JOIN daily_product s ON s.Product_SK = r.Product_SK AND s.ReferenceDate = FullDate""",
    "demand_windows": f"""
        SELECT *, {', '.join(f"sum(DailyQty) OVER ({_P} {frame(n)})::BIGINT AS SalesLast{n}Days" for n in _SPANS)},
          {', '.join(f"avg(DailyQty) OVER ({_P} {frame(n)}) AS AvgSalesLast{n}Days" for n in _SPANS)},
          sum(CASE WHEN DailyQty > 0 THEN 1 ELSE 0 END) OVER ({_P} {frame(30)}) / 30.0 AS Intermittency30Days,
          max(CASE WHEN DailyQty > 0 THEN ReferenceDate END) OVER ({_P} ROWS UNBOUNDED PRECEDING) AS LastSale,
          {', '.join(f"coalesce(lag(DailyQty, {k}) OVER ({_P}), 0) AS Lag{k}" for k in _STEPS)}
        FROM dense_product""",
    "demand_daily": f"""
        SELECT Product_SK, ReferenceDate, DailyQty, {', '.join(f'SalesLast{n}Days' for n in _SPANS)},
          {', '.join(f'AvgSalesLast{n}Days' for n in _SPANS)}, Intermittency30Days,
          {since('ReferenceDate', 'LastSale')} AS DaysSinceLastSale, {', '.join(f'Lag{k}' for k in _STEPS)},
          DailyQty - Lag7 AS Trend7, (dayofweek(ReferenceDate) + 1)::INT AS DayNumberOfWeek,
          CASE WHEN dayofweek(ReferenceDate) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
          month(ReferenceDate)::INT AS MonthNumberOfYear, day(ReferenceDate)::INT AS DayNumberOfMonth
        FROM demand_windows""",
    "monthly_product": """
        SELECT Product_SK, date_trunc('month', ReferenceDate)::DATE AS ReferenceMonth,
          sum(OrderQty)::BIGINT AS MonthlyQty FROM dated_lines GROUP BY ALL""",
    "calendar_months": "SELECT DISTINCT date_trunc('month', FullDate)::DATE AS ReferenceMonth FROM dim_date",
    "dense_product_months": """
        SELECT r.Product_SK, c.ReferenceMonth, coalesce(MonthlyQty, 0) AS MonthlyQty
        FROM (SELECT Product_SK, min(ReferenceMonth) AS a, max(ReferenceMonth) AS b FROM monthly_product GROUP BY ALL) AS r
          JOIN calendar_months c ON c.ReferenceMonth BETWEEN a AND b
          LEFT JOIN monthly_product s ON s.Product_SK = r.Product_SK AND s.ReferenceMonth = c.ReferenceMonth""",
    "value_months": """
        SELECT date_trunc('month', ReferenceDate)::DATE AS ReferenceMonth, sum(LineTotal) AS MonthlySalesAmount
        FROM dated_lines GROUP BY ALL""",
    "dense_value_months": """
        SELECT c.ReferenceMonth, coalesce(MonthlySalesAmount, 0) AS MonthlySalesAmount
        FROM calendar_months c LEFT JOIN value_months v ON c.ReferenceMonth = v.ReferenceMonth
        WHERE c.ReferenceMonth BETWEEN (SELECT min(ReferenceMonth) FROM value_months)
          AND (SELECT max(ReferenceMonth) FROM value_months)""",
    "purchase_days": """
        SELECT p.Product_SK, FullDate AS ReferenceDate, sum(OrderQty)::BIGINT AS Qty, FinishedGoodsFlag
        FROM fact_purchases p JOIN dim_date ON OrderDate_SK = DateKey JOIN dim_product d ON p.Product_SK = d.Product_SK
        GROUP BY ALL""",
    "customer_days": """
        SELECT Customer_SK, ReferenceDate, sum(OrderQty)::BIGINT AS DailyQty, sum(LineTotal) AS Amount
        FROM dated_lines GROUP BY ALL""",
    "dense_customer": """
        SELECT r.Customer_SK, FullDate AS ReferenceDate, coalesce(DailyQty, 0) AS DailyQty, coalesce(Amount, 0) AS Amount
        FROM (SELECT Customer_SK, min(ReferenceDate) AS a, least(max(ReferenceDate) + 365,
                (SELECT max(ReferenceDate) FROM customer_days)) AS b FROM customer_days GROUP BY Customer_SK) AS r
          JOIN dim_date ON FullDate BETWEEN a AND b
          LEFT JOIN customer_days s ON s.Customer_SK = r.Customer_SK AND s.ReferenceDate = FullDate""",
    "product_regions": """
        SELECT ReferenceDate, Product_SK, l.Territory_SK, TerritoryName, sum(OrderQty)::BIGINT AS SalesQty,
          sum(LineTotal) AS SalesAmount
        FROM dated_lines l JOIN dim_territory t ON l.Territory_SK = t.Territory_SK GROUP BY ALL""",
    "region_days": """
        SELECT ReferenceDate, Territory_SK, sum(OrderQty)::BIGINT AS SalesQty, sum(LineTotal) AS SalesAmount
        FROM dated_lines GROUP BY ALL""",
    "early_lines": """
        SELECT l.*, SubCategory FROM dated_lines l JOIN dim_product p ON l.Product_SK = p.Product_SK
          JOIN (SELECT Customer_SK, min(ReferenceDate) AS FirstDay FROM dated_lines GROUP BY ALL) AS f
            ON l.Customer_SK = f.Customer_SK
        WHERE date_diff('day', FirstDay, ReferenceDate) <= 90""",
    "customer_behaviour": f"""
        SELECT e.Customer_SK, count(*) AS TotalOrdersFirst90Days, {m('sum(SubTotal)', 'SpendFirst90Days')},
          {m('any_value(v)', 'TotalHistoricalValue')},
          {q('CAST(sum(SubTotal) AS DOUBLE) / count(*)', 'AvgTicketFirst90Days')},
          count(DISTINCT SubCategory) AS CategoryDiversity, count(DISTINCT Product_SK) AS ProductDiversity,
          CASE WHEN count(*) > 1 THEN floor(date_diff('day', min(ReferenceDate), max(ReferenceDate))
            / (count(*) - 1)::DOUBLE * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE ELSE 90.0::DOUBLE END AS DaysToRepurchase
        FROM early_lines e JOIN (SELECT Customer_SK, sum(SubTotal) AS v FROM fact_sales_order GROUP BY ALL) AS h
          ON e.Customer_SK = h.Customer_SK
        GROUP BY e.Customer_SK""",
    "ranked_customers": """
        SELECT *, row_number() OVER (ORDER BY TotalHistoricalValue) AS rn, count(*) OVER () AS n
        FROM customer_behaviour""",
}

_STOCK = "CAST({} AS DOUBLE) / nullif({}, 0)"


def _flags(ratio: str) -> str:
    return (
        f"CASE WHEN {ratio} > 1.2 THEN 1 ELSE 0 END AS OverstockRiskFlag, "
        f"CASE WHEN {ratio} < 0.8 THEN 1 ELSE 0 END AS StockoutRiskFlag"
    )


OVERVIEW = f"""
SELECT ReferenceDate, TotalSalesQty, TotalPurchaseQty, PurchaseFinishedQty, PurchaseComponentQty, SalesLast30Days,
  coalesce(Prev, 0)::BIGINT AS SalesPrev30Days, PurchasesFinishedLast30Days,
  {q(growth('SalesLast30Days', 'Prev'), 'Growth30Days')},
  {q(f"coalesce({_STOCK.format('PurchasesFinishedLast30Days', 'SalesLast30Days')}, 0)", 'PurchaseSalesRatio')},
  {_flags(_STOCK.format('PurchasesFinishedLast30Days', 'SalesLast30Days'))}
FROM (SELECT *, lag(SalesLast30Days, 30) OVER (ORDER BY ReferenceDate) AS Prev FROM (
  SELECT *, sum(TotalSalesQty) OVER (ORDER BY ReferenceDate {frame(30)})::BIGINT AS SalesLast30Days,
    sum(PurchaseFinishedQty) OVER (ORDER BY ReferenceDate {frame(30)})::BIGINT AS PurchasesFinishedLast30Days
  FROM (SELECT FullDate AS ReferenceDate, coalesce(TotalSalesQty, 0)::BIGINT AS TotalSalesQty,
      coalesce(Total, 0)::BIGINT AS TotalPurchaseQty, coalesce(Finished, 0)::BIGINT AS PurchaseFinishedQty,
      coalesce(Component, 0)::BIGINT AS PurchaseComponentQty
    FROM dim_date
      LEFT JOIN (SELECT ReferenceDate, sum(DailyQty) AS TotalSalesQty FROM daily_product GROUP BY ALL) AS s
        ON FullDate = s.ReferenceDate
      LEFT JOIN (SELECT ReferenceDate, sum(Qty) AS Total, sum(CASE WHEN FinishedGoodsFlag = 1 THEN Qty ELSE 0 END) AS Finished,
          sum(CASE WHEN FinishedGoodsFlag = 0 THEN Qty ELSE 0 END) AS Component FROM purchase_days GROUP BY ALL) AS p
        ON FullDate = p.ReferenceDate
    WHERE FullDate BETWEEN (SELECT min(ReferenceDate) FROM daily_product) AND (SELECT max(ReferenceDate) FROM daily_product)
  ) AS b) AS w) AS g"""

INVENTORY = f"""
SELECT Product_SK, ReferenceDate, SalesLast30Days, PurchasesLast30Days,
  {q(f"coalesce({_STOCK.format('PurchasesLast30Days', 'SalesLast30Days')}, 0)", 'PurchaseSalesRatio')},
  {since('ReferenceDate', 'LastBuy')} AS DaysSinceLastPurchase,
  {_flags(_STOCK.format('PurchasesLast30Days', 'SalesLast30Days'))},
  CASE WHEN date_diff('day', LastBuy, ReferenceDate) >= 30 THEN 1 ELSE 0 END AS NoRecentPurchaseFlag
FROM (SELECT *, sum(DailyQty) OVER ({_P} {frame(30)})::BIGINT AS SalesLast30Days,
    sum(Buy) OVER ({_P} {frame(30)})::BIGINT AS PurchasesLast30Days,
    max(CASE WHEN Buy > 0 THEN ReferenceDate END) OVER ({_P} ROWS UNBOUNDED PRECEDING) AS LastBuy
  FROM (SELECT s.Product_SK, s.ReferenceDate, DailyQty, coalesce(Qty, 0) AS Buy
    FROM dense_product s LEFT JOIN purchase_days p
      ON p.Product_SK = s.Product_SK AND p.ReferenceDate = s.ReferenceDate AND FinishedGoodsFlag = 1) AS b) AS w"""

CUSTOMER = f"""
SELECT w.Customer_SK, ReferenceDate, DailyQty, SalesQtyLast30Days, coalesce(Prev, 0)::BIGINT AS SalesPrev30Days,
  {q(growth('SalesQtyLast30Days', 'Prev'), 'Growth30Days')}, {m('SalesAmountLast30Days')},
  {q("CASE WHEN SalesQtyLast30Days = 0 THEN 0 ELSE CAST(SalesAmountLast30Days AS DOUBLE) / SalesQtyLast30Days END", 'AvgTicket30Days')},
  {since('ReferenceDate', 'LastBuy')} AS DaysSinceLastPurchase,
  CASE WHEN date_diff('day', LastBuy, ReferenceDate) >= 60 THEN 1 ELSE 0 END AS CustomerInactiveFlag,
  CASE WHEN SalesQtyLast30Days > 0 AND SalesQtyLast30Days < 5 THEN 1 ELSE 0 END AS LowFrequencyFlag, CustomerType
FROM (SELECT *, lag(SalesQtyLast30Days, 30) OVER ({_C}) AS Prev FROM (
  SELECT *, sum(DailyQty) OVER ({_C} {frame(30)})::BIGINT AS SalesQtyLast30Days,
    sum(Amount) OVER ({_C} {frame(30)}) AS SalesAmountLast30Days,
    max(CASE WHEN DailyQty > 0 THEN ReferenceDate END) OVER ({_C} ROWS UNBOUNDED PRECEDING) AS LastBuy
  FROM dense_customer) AS a) AS w JOIN dim_customer d ON w.Customer_SK = d.Customer_SK"""

INSIGHTS = f"""
SELECT *, CASE WHEN Growth30Days <= -0.5 THEN 1 ELSE 0 END AS SharpDropFlag,
  CASE WHEN Growth30Days >= 0.5 THEN 1 ELSE 0 END AS HighGrowthFlag,
  CASE WHEN DaysSinceLastSale >= 30 THEN 1 ELSE 0 END AS NoSalesRecentFlag,
  CASE WHEN Growth30Days > 0.1 THEN 1 WHEN Growth30Days < -0.1 THEN -1 ELSE 0 END AS TrendDirection,
  CASE WHEN SalesLast30Days = 0 THEN 0 WHEN SalesLast30Days < 10 THEN 1 ELSE 2 END AS ActivityLevel
FROM (SELECT Product_SK, ReferenceDate, DailyQty, SalesLast7Days, SalesLast30Days,
    coalesce(Prev30, 0)::BIGINT AS SalesPrev30Days, {growth('SalesLast30Days', 'Prev30')} AS Growth30Days,
    coalesce(SalesLast7Days - Prev7, 0)::BIGINT AS Trend7, DaysSinceLastSale,
    rank() OVER (PARTITION BY ReferenceDate ORDER BY SalesLast30Days DESC) AS Ranking30Days
  FROM (SELECT *, lag(SalesLast30Days, 30) OVER ({_P}) AS Prev30, lag(SalesLast7Days, 7) OVER ({_P}) AS Prev7
        FROM demand_daily) AS a) AS b"""

_SHARE = "CASE WHEN P30 = 0 THEN 0 ELSE CAST(R30 AS DOUBLE) / CAST(P30 AS DOUBLE) END"
PRODUCT_REGION = f"""
SELECT r.ReferenceDate, r.Product_SK, Territory_SK, TerritoryName, SalesQty, {m('SalesAmount')},
  {m('R30', 'SalesAmountRegion30Days')}, {m('P30', 'SalesAmountProduct30Days')}, {q(_SHARE, 'RegionShare')},
  CASE WHEN P30 = 0 THEN 'No Sales' WHEN {_SHARE} > 0.4 THEN 'Strong Region'
    WHEN {_SHARE} < 0.1 THEN 'Growth Opportunity' ELSE 'Moderate' END AS ProductRegionPerformanceCategory
FROM (SELECT *, sum(SalesAmount) OVER (PARTITION BY Product_SK, Territory_SK ORDER BY ReferenceDate {frame(30)}) AS R30
      FROM product_regions) AS r
  JOIN (SELECT DISTINCT Product_SK, ReferenceDate, sum(SalesAmount) OVER ({_P} {frame(30)}) AS P30
        FROM product_regions) AS p ON r.Product_SK = p.Product_SK AND r.ReferenceDate = p.ReferenceDate"""

_RG = "(CAST(A30 AS DOUBLE) - CAST(Prev AS DOUBLE)) / CAST(nullif(Prev, 0) AS DOUBLE)"
REGION = f"""
SELECT ReferenceDate, Territory_SK, TerritoryName, SalesQty, {m('SalesAmount')}, Q30 AS SalesQtyLast30Days,
  {m('A30', 'SalesAmountLast30Days')}, {m('coalesce(Prev, 0)', 'SalesAmountPrev30Days')},
  {q(f"CASE WHEN Prev = 0 THEN 0 ELSE {_RG} END", 'Growth30Days')},
  CASE WHEN Prev = 0 THEN 0 WHEN {_RG} > 0.1 THEN 1 WHEN {_RG} < -0.1 THEN -1 ELSE 0 END AS TrendDirection,
  CASE WHEN {_RG} >= 0.3 THEN 1 ELSE 0 END AS HighGrowthFlag,
  CASE WHEN {_RG} <= -0.3 THEN 1 ELSE 0 END AS SharpDropFlag
FROM (SELECT *, lag(A30, 30) OVER ({_T}) AS Prev FROM (
  SELECT *, sum(SalesQty) OVER ({_T} {frame(30)})::BIGINT AS Q30, sum(SalesAmount) OVER ({_T} {frame(30)}) AS A30
  FROM (SELECT FullDate AS ReferenceDate, t.Territory_SK, TerritoryName, coalesce(SalesQty, 0) AS SalesQty,
      coalesce(SalesAmount, 0) AS SalesAmount
    FROM dim_date CROSS JOIN dim_territory t
      LEFT JOIN region_days s ON s.ReferenceDate = FullDate AND s.Territory_SK = t.Territory_SK
    WHERE t.Territory_SK <> -1 AND FullDate BETWEEN (SELECT min(ReferenceDate) FROM region_days)
      AND (SELECT max(ReferenceDate) FROM region_days)) AS b) AS w) AS g"""

_DEMAND = (
    f"SELECT * REPLACE ({', '.join(q(f'AvgSalesLast{n}Days', f'AvgSalesLast{n}Days') for n in _SPANS)}, "
    f"{q('Intermittency30Days', 'Intermittency30Days')}) FROM demand_daily"
)
_MONTHS = (3, 6, 12)


def _monthly(value: str, source: str, over: str, names: dict[str, str], keys: str) -> str:
    win = f"OVER ({over} ROWS BETWEEN {{}} PRECEDING AND CURRENT ROW)"
    sums = ", ".join(f"sum({value}) {win.format(n - 1)} AS s{n}" for n in _MONTHS)
    avgs = ", ".join(f"avg({value}::DOUBLE) {win.format(n - 1)} AS a{n}" for n in _MONTHS)
    lags = ", ".join(f"coalesce(lag({value}, {k}) OVER ({over}), 0) AS l{k}" for k in (1, 3, 12))
    cast = (lambda e, n: m(e, n)) if value == "MonthlySalesAmount" else (lambda e, n: f"({e})::BIGINT AS {n}")
    return f"""
    SELECT {keys} ReferenceMonth, {cast(value, value)},
      {', '.join(cast(f's{n}', names['sum'].format(n)) for n in _MONTHS)},
      {', '.join(q(f'a{n}', names['avg'].format(n)) for n in _MONTHS)}, {names['since']},
      {', '.join(cast(f'l{k}', names['lag'].format(k)) for k in (1, 3, 12))},
      {cast(f'{value} - l3', names['trend'])}, month(ReferenceMonth)::INT AS MonthNumber,
      year(ReferenceMonth)::INT AS YearNumber
    FROM (SELECT *, {sums}, {avgs}, {lags},
      max(CASE WHEN {value} > 0 THEN ReferenceMonth END) OVER ({over} ROWS UNBOUNDED PRECEDING) AS LastSale
      FROM {source}) AS w"""


MONTHLY_PRODUCT = _monthly(
    "MonthlyQty", "dense_product_months", "PARTITION BY Product_SK ORDER BY ReferenceMonth",
    {"sum": "SalesLast{}Months", "avg": "AvgSalesLast{}Months", "lag": "Lag{}Month", "trend": "Trend3Months",
     "since": q("coalesce(date_diff('day', LastSale, ReferenceMonth) / 30.0, 999)", "MonthsSinceLastSale")},
    "Product_SK,")
MONTHLY_VALUE = _monthly(
    "MonthlySalesAmount", "dense_value_months", "ORDER BY ReferenceMonth",
    {"sum": "SalesAmountLast{}Months", "avg": "AvgSalesAmountLast{}Months", "lag": "LagAmount{}Month",
     "trend": "TrendAmount3Months",
     "since": "coalesce(date_diff('month', LastSale, ReferenceMonth), 999)::BIGINT AS MonthsSinceLastSaleAmount"},
    "")

# Second series for the stacked model input: purchases per month.
EXTRA_SERIES = "SELECT date_trunc('month', FullDate)::DATE AS YearMonth, sum(LineTotal)::DOUBLE AS label FROM fact_purchases JOIN dim_date ON OrderDate_SK = DateKey GROUP BY ALL"
SERIES = f"""
SELECT YearMonth, month(YearMonth)::INT AS month, year(YearMonth)::INT AS year, {q('label', 'label')},
  {q('lag_1_month', 'lag_1_month')}, {q('lag_3_month', 'lag_3_month')}, {q('m3', 'rolling_mean_3m')},
  {q('m6', 'rolling_mean_6m')}
FROM (SELECT *, lag(label, 1) OVER (ORDER BY YearMonth, label) AS lag_1_month,
    lag(label, 3) OVER (ORDER BY YearMonth, label) AS lag_3_month,
    avg(label) OVER (ORDER BY YearMonth, label ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m3,
    avg(label) OVER (ORDER BY YearMonth, label ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS m6
  FROM (SELECT ReferenceMonth AS YearMonth, MonthlySalesAmount::DOUBLE AS label FROM dense_value_months
        UNION ALL {EXTRA_SERIES}) AS u) AS w
WHERE lag_3_month IS NOT NULL"""


def stacked_series(t: Tables):
    monthly = features.demand_value_monthly(t).select(
        F.col("ReferenceMonth").alias("YearMonth"), F.col("MonthlySalesAmount").alias("label")
    )
    extra = (
        t["fact_purchases"].join(t["dim_date"], F.col("OrderDate_SK") == F.col("DateKey"))
        .groupBy(F.trunc("FullDate", "month").alias("YearMonth")).agg(F.sum("LineTotal").alias("label"))
    )
    return features.model_series(monthly, extra)


# The single window operators, on daily demand.

def range_days(t: Tables):
    return ts.trailing_days(features.daily_product(t), ["Product_SK"], "ReferenceDate", "DailyQty", 30, "Last30Days")


def rows_frame(t: Tables):
    return ts.trailing(
        features.daily_product(t), ["Product_SK"], "ReferenceDate",
        {"Last5Rows": ("DailyQty", 5)}, {"Mean5Rows": ("DailyQty", 5)})


def last_large(t: Tables):
    return ts.last_event(
        features.daily_product(t), ["Product_SK"], "ReferenceDate", F.col("DailyQty") >= 40, "LastLargeDay")


def lag_default(t: Tables):
    return ts.lagged(
        features.daily_product(t), ["Product_SK"], "ReferenceDate",
        {"Previous": ("DailyQty", 1), "ThirdBack": ("DailyQty", 3)}, 0)


def densified(t: Tables):
    monthly = features.dated_lines(t).groupBy(
        "Customer_SK", F.trunc("ReferenceDate", "month").alias("ReferenceMonth")
    ).agg(F.sum("OrderQty").cast("long").alias("MonthlyQty"))
    return ts.densify(monthly, ["Customer_SK"], "ReferenceMonth", ["MonthlyQty"], step="month")


def ranked(t: Tables):
    return ts.rank_within(features.daily_product(t), "ReferenceDate", "DailyQty", "DayRank")


def register(reg: Registry) -> None:
    def add(name: str, build: Callable, sql: str) -> None:
        reg.add(name, lambda s, d, b=build: tidy(b(Tables(s, d))), with_tables(sql, SQL))

    add("g01_demand_product_daily", features.demand_product_daily, _DEMAND)
    add("g02_demand_product_monthly", features.demand_product_monthly, MONTHLY_PRODUCT)
    add("g03_demand_value_monthly", features.demand_value_monthly, MONTHLY_VALUE)
    add("g04_insights_overview_daily", features.insights_overview_daily, OVERVIEW)
    add("g05_inventory_product_daily", features.inventory_product_daily, INVENTORY)
    add("g06_customer_daily", features.customer_daily, CUSTOMER)
    add("g07_product_insights_daily", features.product_insights_daily,
        f"SELECT * REPLACE ({q('Growth30Days', 'Growth30Days')}) FROM ({INSIGHTS}) AS i")
    add("g08_product_region_daily", features.product_region_daily, PRODUCT_REGION)
    add("g09_region_daily", features.region_daily, REGION)
    add("g10_customer_classification", features.customer_classification, """
        SELECT * EXCLUDE (rn, n), CASE
          WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.66::DOUBLE * n)) THEN 'GOLD'
          WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.33::DOUBLE * n)) THEN 'SILVER'
          ELSE 'BRONZE' END AS ClientRank FROM ranked_customers""")
    add("g11_model_series", stacked_series, SERIES)
    add("g12_range_days", range_days,
        f"SELECT *, sum(DailyQty) OVER ({_P} {frame(30)})::BIGINT AS Last30Days FROM daily_product")
    add("g13_rows_frame", rows_frame,
        f"""SELECT *, sum(DailyQty) OVER ({_P} ROWS 4 PRECEDING)::BIGINT AS Last5Rows,
              {q(f'avg(DailyQty) OVER ({_P} ROWS 4 PRECEDING)', 'Mean5Rows')} FROM daily_product""")
    add("g14_last_event", last_large,
        f"""SELECT *, max(CASE WHEN DailyQty >= 40 THEN ReferenceDate END) OVER ({_P} ROWS UNBOUNDED PRECEDING)
              AS LastLargeDay FROM daily_product""")
    add("g15_lag_default", lag_default,
        f"""SELECT *, coalesce(lag(DailyQty, 1) OVER ({_P}), 0) AS Previous,
              coalesce(lag(DailyQty, 3) OVER ({_P}), 0) AS ThirdBack FROM daily_product""")
    add("g16_densify", densified, """
        SELECT * FROM (WITH monthly AS (SELECT Customer_SK, date_trunc('month', ReferenceDate)::DATE AS ReferenceMonth,
            sum(OrderQty)::BIGINT AS q FROM dated_lines GROUP BY ALL)
        SELECT r.Customer_SK, c.ReferenceMonth, coalesce(q, 0) AS MonthlyQty
        FROM (SELECT Customer_SK, min(ReferenceMonth) AS a, max(ReferenceMonth) AS b FROM monthly GROUP BY ALL) AS r
          JOIN calendar_months c ON c.ReferenceMonth BETWEEN a AND b
          LEFT JOIN monthly s ON s.Customer_SK = r.Customer_SK AND s.ReferenceMonth = c.ReferenceMonth) AS d""")
    add("g17_rank_within", ranked,
        """SELECT *, rank() OVER (PARTITION BY ReferenceDate ORDER BY DailyQty DESC) AS DayRank FROM daily_product""")
