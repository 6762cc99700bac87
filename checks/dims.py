"""Dimensions, facts, keys and upserts: a second load on top of an earlier one."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.clean import cleaned, rows
from checks.common import Registry, m, q, tidy
from checks.mapping import CALENDAR, Tables, with_tables
from tarnlake.operators.keys import key_report, number_rows, with_unknown
from tarnlake.operators.ledger import assign_from_ledger
from tarnlake.operators.merge import ACTION, duplicate_keys, merge_counts, scd1_merge
from tarnlake.plans import dims, facts
from tarnlake.session import checkpointed, fresh_folder
from tarnlake.sinks import tables as sink
from tarnlake.sinks.ranges import compact_ranges, read_ranges, staged, upsert_ranges

_NR = "'Not registered'"

# Source rows of each dimension in SQL, from the cleaned tables.
SOURCES = {
    "dim_currency": """
        SELECT * FROM (SELECT CurrencyRateID, FromCurrencyCode, coalesce(f.CurrencyName, 'Not registered') AS FromCurrencyName,
          ToCurrencyCode, coalesce(t.CurrencyName, 'Not registered') AS ToCurrencyName, CurrencyRateDate,
          AverageRate, EndOfDayRate, row_number() OVER (PARTITION BY FromCurrencyCode, ToCurrencyCode, CurrencyRateDate
            ORDER BY EndOfDayRate DESC, CurrencyRateID DESC) AS rn
        FROM clean_sales_currency_rate r LEFT JOIN clean_sales_currency f ON FromCurrencyCode = f.CurrencyCode
          LEFT JOIN clean_sales_currency t ON ToCurrencyCode = t.CurrencyCode) AS x WHERE rn = 1""",
    "dim_customer": f"""
        SELECT CustomerID, c.PersonID, c.StoreID,
          CASE WHEN c.PersonID IS NOT NULL THEN 'PERSON' WHEN c.StoreID IS NOT NULL THEN 'STORE'
               ELSE 'NOT REGISTERED' END AS CustomerType,
          CASE WHEN c.PersonID IS NOT NULL THEN concat_ws(' ', FirstName, LastName) ELSE {_NR} END AS PersonName,
          CASE WHEN c.StoreID IS NOT NULL THEN StoreName ELSE {_NR} END AS StoreName
        FROM clean_sales_customer c LEFT JOIN clean_person p ON c.PersonID = p.PersonID
          LEFT JOIN clean_sales_store s ON c.StoreID = s.StoreID""",
    "dim_location": f"""
        SELECT AddressID, coalesce(AddressLine1, {_NR}) AS AddressLine1, AddressLine2, coalesce(City, {_NR}) AS City,
          coalesce(StateProvinceName, {_NR}) AS StateProvinceName, coalesce(CountryName, {_NR}) AS CountryName,
          coalesce(PostalCode, {_NR}) AS PostalCode, SpatialLocation FROM clean_person_address""",
    "dim_product": f"""
        SELECT ProductID, ProductName, coalesce(ProductCategoryName, {_NR}) AS Category,
          coalesce(ProductSubcategoryName, {_NR}) AS SubCategory, coalesce(ProductModelName, {_NR}) AS ModelName,
          StandardCost, ListPrice, coalesce(CAST(FinishedGoodsFlag AS INT), 0) AS FinishedGoodsFlag FROM clean_production""",
    "dim_supplier": f"""
        SELECT VendorID AS SupplierID, coalesce(VendorName, {_NR}) AS SupplierName, CreditRating,
          coalesce(ActiveFlag, false) AS IsActiveSupplier FROM clean_purchasing_vendor""",
    "dim_territory": """
        SELECT TerritoryID, TerritoryName, TerritoryGroup, CountryRegionCode FROM clean_sales_territory""",
}
# The unknown member of each dimension, written out.
UNKNOWN = {
    "dim_currency": f"""-1 AS CurrencyRateID, 'UNK' AS FromCurrencyCode, {_NR} AS FromCurrencyName, 'UNK' AS ToCurrencyCode,
        {_NR} AS ToCurrencyName, NULL AS CurrencyRateDate, 0 AS AverageRate, 0 AS EndOfDayRate""",
    "dim_customer": f"""-1 AS CustomerID, NULL AS PersonID, NULL AS StoreID, 'NOT REGISTERED' AS CustomerType,
        {_NR} AS PersonName, {_NR} AS StoreName""",
    "dim_location": f"""-1 AS AddressID, {_NR} AS AddressLine1, NULL AS AddressLine2, {_NR} AS City, {_NR} AS StateProvinceName,
        {_NR} AS CountryName, {_NR} AS PostalCode, NULL AS SpatialLocation""",
    "dim_product": f"""-1 AS ProductID, {_NR} AS ProductName, {_NR} AS Category, {_NR} AS SubCategory, {_NR} AS ModelName,
        0 AS StandardCost, 0 AS ListPrice, 0 AS FinishedGoodsFlag""",
    "dim_supplier": f"-1 AS SupplierID, {_NR} AS SupplierName, NULL AS CreditRating, false AS IsActiveSupplier",
    "dim_territory": f"-1 AS TerritoryID, {_NR} AS TerritoryName, {_NR} AS TerritoryGroup, {_NR} AS CountryRegionCode",
}
COLUMNS = {
    "dim_currency": "CurrencyRateID FromCurrencyCode FromCurrencyName ToCurrencyCode ToCurrencyName CurrencyRateDate AverageRate EndOfDayRate",
    "dim_customer": "CustomerID PersonID StoreID CustomerType PersonName StoreName",
    "dim_location": "AddressID AddressLine1 AddressLine2 City StateProvinceName CountryName PostalCode SpatialLocation",
    "dim_product": "ProductID ProductName Category SubCategory ModelName StandardCost ListPrice FinishedGoodsFlag",
    "dim_supplier": "SupplierID SupplierName CreditRating IsActiveSupplier",
    "dim_territory": "TerritoryID TerritoryName TerritoryGroup CountryRegionCode",
}
# The earlier load: which members it knew, and values it still had (both engines read
# these expressions).
EARLIER = {
    "dim_currency": ("FromCurrencyCode = 'USD'", {"AverageRate": "CASE WHEN EndOfDayRate > 50 THEN AverageRate + 1 ELSE AverageRate END"}),
    "dim_customer": ("CustomerType <> 'STORE'", {"StoreName": "CASE WHEN StoreID < 50 THEN 'Old ' || StoreName ELSE StoreName END"}),
    "dim_location": ("CountryName <> 'ASIA'", {"SpatialLocation": "CASE WHEN City = 'MACHINERY' THEN NULL ELSE SpatialLocation END"}),
    "dim_product": ("ModelName <> 'Model SMALL'", {"ListPrice": "CASE WHEN FinishedGoodsFlag = 1 THEN ListPrice + 1 ELSE ListPrice END"}),
    "dim_supplier": ("IsActiveSupplier", {"CreditRating": "CASE WHEN CreditRating = 3 THEN 1 ELSE CreditRating END"}),
    "dim_territory": ("TerritoryGroup = 'West'", {"CountryRegionCode": "CASE WHEN TerritoryName = 'AFRICA' THEN 'XX' ELSE CountryRegionCode END"}),
}
MONEY, RATES = {"StandardCost", "ListPrice"}, {"AverageRate", "EndOfDayRate"}

CLEAN = {
    n: rows(n)
    for n in (
        "clean_sales_currency_rate", "clean_sales_currency", "clean_sales_customer", "clean_person",
        "clean_sales_store", "clean_person_address", "clean_production", "clean_purchasing_vendor",
        "clean_sales_territory", "clean_sales_order_header", "clean_sales_order_detail",
        "clean_purchasing_order", "clean_purchasing_order_line",
    )
}


def source(spark, sf_dir: str, name: str):
    def c(table: str):
        return cleaned(spark, sf_dir, f"clean_{table}")

    return {
        "dim_currency": lambda: dims.currency_source(c("sales_currency_rate"), c("sales_currency")),
        "dim_customer": lambda: dims.customer_source(c("sales_customer"), c("person"), c("sales_store")),
        "dim_location": lambda: dims.location_source(c("person_address")),
        "dim_product": lambda: dims.product_source(c("production")),
        "dim_supplier": lambda: dims.supplier_source(c("purchasing_vendor")),
        "dim_territory": lambda: dims.territory_source(c("sales_territory")),
    }[name]()


def second_load(spark, sf_dir: str, name: str):
    now = checkpointed(source(spark, sf_dir, name))
    keep, changed = EARLIER[name]
    earlier = now.filter(keep).withColumns(
        {col: F.expr(e).cast(now.schema[col].dataType) for col, e in changed.items()}
    )
    return tidy(dims.load_dimension(name, now, dims.first_load(name, earlier)))


def second_load_sql(name: str) -> str:
    d, cols = dims.DIMENSIONS[name], COLUMNS[name].split()
    keep, changed = EARLIER[name]
    keys = ", ".join(d.keys)
    on = " AND ".join(f"t.{k} = s.{k}" for k in d.keys)
    compare = [c for c in cols if c not in d.keys]
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compare)
    old = ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in cols)

    def shown(c: str, e: str) -> str:
        return m(e, c) if c in MONEY else q(e, c) if c in RATES else f"{e} AS {c}"

    unknown = UNKNOWN[name]
    picked = ", ".join(shown(c, c if c in d.keys else f"CASE WHEN upd THEN s_{c} ELSE {c} END") for c in cols)
    body = f"""
    SELECT {d.sk}, {picked}, CASE WHEN upd THEN 'update' ELSE 'keep' END AS merge_action
    FROM (SELECT t.*, {', '.join(f's.{c} AS s_{c}' for c in compare)}, s.{d.keys[0]} IS NOT NULL AND ({differs}) AS upd
          FROM target_rows t LEFT JOIN source_rows s ON {on}) AS j
    UNION ALL
    SELECT top + row_number() OVER (ORDER BY {keys}), {', '.join(shown(c, c) for c in cols)}, 'insert'
    FROM source_rows s CROSS JOIN (SELECT max({d.sk}) AS top FROM target_rows) AS x
    WHERE NOT EXISTS (SELECT 1 FROM target_rows t WHERE {on})
    UNION ALL SELECT -1, {', '.join(shown(c, c) for c in cols)}, 'keep' FROM (SELECT {unknown}) AS u"""
    return with_tables(body, {
        **CLEAN,
        "source_rows": f"SELECT {', '.join(cols)} FROM ({SOURCES[name]}) AS b",
        "target_rows": f"SELECT row_number() OVER (ORDER BY {keys}) AS {d.sk}, * FROM (SELECT {old} FROM source_rows WHERE {keep}) AS o",
    })


def calendar(spark, sf_dir: str):
    t = Tables(spark, sf_dir)
    first = t["orders"].agg(F.min(F.to_date("o_orderdate")).cast("string")).first()[0]
    last = t["lineitem"].agg(F.max(F.to_date("l_shipdate")).cast("string")).first()[0]
    return dims.dim_date(spark, first, last)


# Facts: looked up in dimensions of their first load.


FACT_DIMS = {
    "fact_sales_order": ("dim_customer", "dim_currency", "dim_location", "dim_territory"),
    "fact_sales_order_detail": ("dim_product",),
    "fact_purchases": ("dim_product", "dim_supplier"),
}


def loaded(spark, sf_dir: str, fact: str) -> dict:
    out = {n: dims.first_load(n, source(spark, sf_dir, n)) for n in FACT_DIMS[fact]}
    out["dim_date"] = dims.dim_date(spark, *CALENDAR)
    return out


def keyed_sql() -> dict[str, str]:
    """First load of every dimension, without its unknown member (a lookup never
    finds it)."""
    out = {}
    for n, d in dims.DIMENSIONS.items():
        out[f"keyed_{n}"] = (
            f"SELECT row_number() OVER (ORDER BY {', '.join(d.keys)}) AS {d.sk}, {', '.join(COLUMNS[n].split())} "
            f"FROM ({SOURCES[n]}) AS b"
        )
    return out


_ORDER_MONEY = ("SubTotal", "ShippingCost", "TaxAmt")
FACT_SQL = {
    "new_orders": """
        SELECT OrderID, ShipToAddressID, Customer_SK, OrderDate_SK, ShipDate_SK, Currency_SK, Location_SK,
          Territory_SK, SubTotal, ShippingCost, TaxAmt FROM (
        SELECT SalesOrderID AS OrderID, ShipToAddressID, coalesce(Customer_SK, -1) AS Customer_SK,
          coalesce(od.DateKey, -1) AS OrderDate_SK, coalesce(sd.DateKey, -1) AS ShipDate_SK,
          coalesce(Currency_SK, -1) AS Currency_SK, coalesce(Location_SK, -1) AS Location_SK,
          coalesce(Territory_SK, -1) AS Territory_SK, SubTotal, Freight AS ShippingCost, TaxAmt,
          row_number() OVER (PARTITION BY SalesOrderID ORDER BY sd.DateKey DESC NULLS LAST, od.DateKey DESC NULLS LAST) AS rn
        FROM clean_sales_order_header h LEFT JOIN keyed_dim_customer c ON h.CustomerID = c.CustomerID
          LEFT JOIN dim_date od ON CAST(OrderDate AS DATE) = od.FullDate
          LEFT JOIN dim_date sd ON CAST(ShipDate AS DATE) = sd.FullDate
          LEFT JOIN keyed_dim_currency r ON h.CurrencyRateID = r.CurrencyRateID
          LEFT JOIN keyed_dim_location l ON ShipToAddressID = AddressID
          LEFT JOIN keyed_dim_territory t ON h.TerritoryID = t.TerritoryID) AS x WHERE rn = 1""",
    "new_details": """
        SELECT SalesOrderDetailID AS SalesID, SalesOrderID AS OrderID, coalesce(Product_SK, -1) AS Product_SK,
          OrderQty, UnitPrice, UnitPriceDiscount, LineTotal
        FROM clean_sales_order_detail d LEFT JOIN keyed_dim_product p ON d.ProductID = p.ProductID""",
    "new_purchases": """
        SELECT PurchaseOrderDetailID AS PurchaseID, h.PurchaseOrderID AS OrderID, coalesce(Product_SK, -1) AS Product_SK,
          coalesce(Supplier_SK, -1) AS Supplier_SK, coalesce(od.DateKey, -1) AS OrderDate_SK,
          coalesce(sd.DateKey, -1) AS ShipDate_SK, OrderQuantity AS OrderQty, ReceivedQuantity, RejectedQuantity,
          StockedQuantity, UnitPrice, LineTotal, SubTotal, TaxAmount AS TaxAmt, Freight AS ShippingCost, TotalDue
        FROM clean_purchasing_order_line l JOIN clean_purchasing_order h ON l.PurchaseOrderID = h.PurchaseOrderID
          LEFT JOIN keyed_dim_product p ON l.ProductID = p.ProductID
          LEFT JOIN keyed_dim_supplier s ON VendorID = SupplierID
          LEFT JOIN dim_date od ON OrderDate = od.FullDate LEFT JOIN dim_date sd ON ShipDate = sd.FullDate""",
}
FACT_MONEY = {"SubTotal", "ShippingCost", "TaxAmt", "UnitPrice", "UnitPriceDiscount", "LineTotal", "TotalDue"}
# The earlier load of a fact: rows it held and one value it held differently.
FACT_EARLIER = {
    "fact_sales_order": ("OrderDate_SK < 20000101", "Territory_SK", "CASE WHEN Territory_SK = 2 THEN -1 ELSE Territory_SK END"),
    "fact_sales_order_detail": ("OrderQty <= 40", "OrderQty", "CASE WHEN OrderQty > 30 THEN OrderQty - 1 ELSE OrderQty END"),
    "fact_purchases": ("OrderDate_SK < 20000101", "StockedQuantity", "CASE WHEN RejectedQuantity > 5 THEN 0 ELSE StockedQuantity END"),
}


def fact_rows(spark, sf_dir: str, name: str):
    d = loaded(spark, sf_dir, name)

    def c(table: str):
        return cleaned(spark, sf_dir, f"clean_{table}")

    if name == "fact_sales_order":
        return facts.fact_sales_order(c("sales_order_header"), d)
    if name == "fact_sales_order_detail":
        return facts.fact_sales_order_detail(c("sales_order_detail"), d["dim_product"])
    return facts.fact_purchases(c("purchasing_order_line"), c("purchasing_order"), d)


def fact_load(spark, sf_dir: str, name: str):
    # Stored, as the tables between two jobs are: both loads start from it.
    now = staged(fact_rows(spark, sf_dir, name))
    keep, column, old = FACT_EARLIER[name]
    earlier = now.filter(keep).withColumn(column, F.expr(old).cast(now.schema[column].dataType))
    # Through stored tables: the earlier load, then the upsert that adds files to it.
    path, keys = fresh_folder(spark, name), list(facts.FACT_KEYS[name])
    facts.upsert_fact(name, earlier, path, staged=True)
    done = facts.upsert_fact(name, now, path, staged=True)
    return tidy(with_actions(read_ranges(spark, path, keys), done, keys))


def with_actions(stored, done, keys):
    """Every stored row with what the last load did to it."""
    told = stored.join(done.changed.select(*keys, ACTION), keys, "left")
    return told.select(*stored.columns, F.coalesce(ACTION, F.lit("keep")).alias(ACTION))


def fact_load_sql(name: str, new: str, columns: list[str]) -> str:
    keep, column, old = FACT_EARLIER[name]
    key = facts.FACT_KEYS[name][0]
    shown = ", ".join(m(f"n.{c}", c) if c in FACT_MONEY else f"n.{c}" for c in columns)
    return with_tables(f"""
        SELECT {shown}, CASE WHEN o.{key} IS NULL THEN 'insert' WHEN o.{column} <> n.{column} THEN 'update'
          ELSE 'keep' END AS merge_action
        FROM {new} n LEFT JOIN (SELECT {key}, {old} AS {column} FROM {new} WHERE {keep}) AS o ON n.{key} = o.{key}""",
        {**CLEAN, **keyed_sql(), **FACT_SQL})


# Upsert of product and supplier pairs: pairs known before a date, then later lines.
PAIRS = {
    side: f"""
        SELECT l_partkey AS ProductID, l_suppkey AS SupplierID, l_quantity AS LastQuantity,
          CAST(l_extendedprice AS DECIMAL(18,2)) AS LastPrice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey,
            l_linenumber, l_extendedprice, l_quantity, l_discount) AS rn
          FROM lineitem WHERE CAST(l_shipdate AS DATE) {op} DATE '1998-06-01') AS x WHERE rn = 1"""
    for side, op in (("pairs_before", "<"), ("pairs_after", ">="))
}
MERGED_PAIRS = """
    SELECT coalesce(t.ProductID, s.ProductID) AS ProductID, coalesce(t.SupplierID, s.SupplierID) AS SupplierID,
      CASE WHEN s.ProductID IS NULL THEN t.LastQuantity ELSE s.LastQuantity END AS LastQuantity,
      CASE WHEN s.ProductID IS NULL OR t.LastQuantity = s.LastQuantity THEN CAST(t.LastPrice AS DOUBLE)
        ELSE CAST(s.LastPrice AS DOUBLE) END AS LastPrice,
      CASE WHEN t.ProductID IS NULL THEN 'insert' WHEN s.ProductID IS NULL OR t.LastQuantity = s.LastQuantity
        THEN 'keep' ELSE 'update' END AS merge_action
    FROM pairs_before t FULL JOIN pairs_after s ON t.ProductID = s.ProductID AND t.SupplierID = s.SupplierID"""


def pair_frames(spark, sf_dir: str):
    base = f"parquet.`{sf_dir}/lineitem.parquet`"
    return [spark.sql(PAIRS[p].replace("FROM lineitem", f"FROM {base}")) for p in ("pairs_before", "pairs_after")]


def merged_pairs(spark, sf_dir: str):
    target, new = pair_frames(spark, sf_dir)
    return scd1_merge(target, new, ["ProductID", "SupplierID"], ["LastQuantity"])


def stored_pairs(spark, sf_dir: str):
    """The same merge through stored files of key ranges, folded together afterwards."""
    target, new = pair_frames(spark, sf_dir)
    path, keys = fresh_folder(spark, "pairs"), ["ProductID", "SupplierID"]
    upsert_ranges(target, path, keys, ["LastQuantity"])
    done = upsert_ranges(new, path, keys, ["LastQuantity"])
    compact_ranges(spark, path, keys)
    return with_actions(read_ranges(spark, path, keys), done, keys)


def ledger_keys(spark, sf_dir: str):
    """Two loads side by side on one stored target, then one of them again: every pair has one key, and no key two pairs."""
    pairs, path, natural = lines(spark, sf_dir).select("l_partkey", "l_suppkey").distinct(), fresh_folder(spark, "ledger"), ["l_partkey", "l_suppkey"]
    target = assign_from_ledger(pairs.filter("l_partkey % 3 = 0"), None, "Pair_SK", natural, path, 1000)
    loads = [assign_from_ledger(pairs.filter(f"l_partkey % 3 <> 2 AND l_suppkey % 2 = {k}"), target, "Pair_SK", natural, path, 1000) for k in (0, 1)]
    stored = checkpointed(target.unionByName(loads[0]).unionByName(loads[1]))
    again = assign_from_ledger(pairs, stored, "Pair_SK", natural, path, 1000)
    whole = stored.withColumn("load", F.when(F.col("l_partkey") % 3 == 0, 0).otherwise(1)).unionByName(again.withColumn("load", F.lit(2)))
    holders = whole.groupBy("Pair_SK").agg(F.count("*").alias("holders"))
    return whole.join(holders, "Pair_SK").select(*natural, "load", "holders", (F.col("Pair_SK") > 0).alias("keyed"))


def lines(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def overwritten(spark, sf_dir: str):
    """Two versions of a table, the second with one more column and read from the first."""
    path = fresh_folder(spark, "versions")
    sink.overwrite(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey"), path)
    first = sink.read_current(spark, path)
    sink.overwrite(first.withColumn("doubled", F.col("o_orderkey") * 2), path, ["o_orderkey"])
    return sink.read_current(spark, path)


def appended(spark, sf_dir: str):
    """The same batch offered twice is added once; a later batch is added."""
    path = fresh_folder(spark, "append")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    done = orders.filter("o_orderstatus = 'F'")
    for batch in (done, done, orders):
        sink.append_new(batch, path, ["o_orderkey"])
    return spark.read.parquet(path)


def feature_table(spark, sf_dir: str):
    path = fresh_folder(spark, "feature")
    monthly = (
        lines(spark, sf_dir).groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("month"))
        .agg(F.sum("l_quantity").alias("qty"))
    )
    sink.replace_feature_table(monthly, path, ["l_partkey", "month"])
    return sink.read_current(spark, path)


def commented(spark, sf_dir: str):
    dim = Tables(spark, sf_dir)["dim_customer"]
    return sink.with_comments(dim, {"Customer_SK": "surrogate key", "CustomerID": "natural key"})


def unknown_member(spark, sf_dir: str):
    d = dims.DIMENSIONS["dim_supplier"]
    vendors = source(spark, sf_dir, "dim_supplier").withColumn("Supplier_SK", F.col("SupplierID") + 1)
    once = with_unknown(vendors, d.sk, d.unknown)
    return with_unknown(once, d.sk, d.unknown)


def register(reg: Registry) -> None:
    reg.add("b01_versioned_overwrite", overwritten,
            "SELECT o_orderkey, o_custkey, o_orderkey * 2 AS doubled FROM orders")
    reg.add("b02_append_new", appended, "SELECT o_orderkey, o_orderstatus FROM orders")
    reg.add("b03_scd1_merge", lambda s, d: tidy(merged_pairs(s, d)), with_tables(MERGED_PAIRS, PAIRS))
    reg.add("b03_stored_merge", lambda s, d: tidy(stored_pairs(s, d)), with_tables(MERGED_PAIRS, PAIRS))
    reg.add("b04_merge_counts", lambda s, d: merge_counts(merged_pairs(s, d)), with_tables(
        f"""SELECT count_if(merge_action = 'insert')::BIGINT AS inserted, count_if(merge_action = 'update')::BIGINT AS updated,
              count_if(merge_action = 'keep')::BIGINT AS kept FROM ({MERGED_PAIRS}) AS p""", PAIRS))
    reg.add("b05_duplicate_source_keys", lambda s, d: duplicate_keys(lines(s, d), ["l_orderkey", "l_linenumber"]),
            "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
    reg.add("b06_unknown_member", unknown_member, with_tables(
        f"SELECT b.*, SupplierID + 1 AS Supplier_SK FROM ({SOURCES['dim_supplier']}) AS b "
        "UNION ALL SELECT -1, 'Not registered', NULL, false, -1", CLEAN))
    reg.add("b07_feature_table", feature_table,
            "SELECT l_partkey, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL")
    reg.add("b08_key_report", lambda s, d: key_report(lines(s, d), ["l_orderkey", "l_linenumber"]), """
        SELECT sum(n)::BIGINT AS total_rows, 0::BIGINT AS null_rows, count_if(n > 1)::BIGINT AS duplicate_keys
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) AS g""")
    reg.add("b09_column_comments", commented, with_tables("SELECT * FROM dim_customer"))

    reg.add("d01_surrogate_keys",
            lambda s, d: number_rows(lines(s, d).select("l_partkey", "l_suppkey").distinct(), ["l_partkey", "l_suppkey"], "Pair_SK"),
            """SELECT *, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS Pair_SK
               FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) AS p""")
    reg.add("d01_ledger_keys", ledger_keys, """
        SELECT DISTINCT l_partkey, l_suppkey, CASE l_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS load, 1::BIGINT AS holders, true AS keyed
        FROM lineitem""")
    for n, name in ((2, "dim_currency"), (3, "dim_customer"), (5, "dim_location"), (6, "dim_product"),
                    (7, "dim_supplier"), (8, "dim_territory")):
        reg.add(f"d{n:02d}_{name}", lambda s, d, x=name: second_load(s, d, x), second_load_sql(name))
    reg.add("d04_dim_date", calendar, """
        SELECT CAST(strftime(FullDate, '%Y%m%d') AS INT) AS DateKey, FullDate, (dayofweek(FullDate) + 1)::INT AS DayNumberOfWeek,
          dayname(FullDate) AS DayNameOfWeek, day(FullDate)::INT AS DayNumberOfMonth, month(FullDate)::INT AS MonthNumberOfYear,
          monthname(FullDate) AS MonthName, quarter(FullDate)::INT AS CalendarQuarter, year(FullDate)::INT AS CalendarYear,
          CASE WHEN dayofweek(FullDate) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend
        FROM (SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders),
          (SELECT max(l_shipdate)::DATE FROM lineitem), INTERVAL 1 DAY))::DATE AS FullDate) AS d""")

    columns = {
        "fact_sales_order": "OrderID ShipToAddressID Customer_SK OrderDate_SK ShipDate_SK Currency_SK Location_SK Territory_SK SubTotal ShippingCost TaxAmt",
        "fact_sales_order_detail": "SalesID OrderID Product_SK OrderQty UnitPrice UnitPriceDiscount LineTotal",
        "fact_purchases": "PurchaseID OrderID Product_SK Supplier_SK OrderDate_SK ShipDate_SK OrderQty ReceivedQuantity RejectedQuantity StockedQuantity UnitPrice LineTotal SubTotal TaxAmt ShippingCost TotalDue",
    }
    for n, (name, new) in enumerate(zip(columns, ("new_orders", "new_details", "new_purchases")), 1):
        reg.add(f"e{n:02d}_{name}", lambda s, d, x=name: fact_load(s, d, x),
                fact_load_sql(name, new, columns[name].split()))


