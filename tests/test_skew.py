"""One product, customer and order day hold a third of all lines; joins are shuffled
and skewed sides are split."""

import contextlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarnlake.operators.dedup import dedup
from tarnlake.operators.lookup import lookup_sk
from tarnlake.operators.quality import duplicate_checks
from tarnlake.plans import dims, features, gold, measures

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextlib.contextmanager
def settings(spark, values):
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in values:
            spark.conf.unset(k)


@pytest.fixture(scope="module")
def star(spark):
    hot = F.col("id") % 3 == 0
    n = 6000

    def pick(m):
        return F.when(hot, 1).otherwise(F.col("id") % m + 1).cast("long")

    orders = spark.range(n).select(
        F.col("id").alias("OrderID"), pick(50).alias("Customer_SK"),
        (20230101 + F.when(hot, 0).otherwise(F.col("id") % 28)).cast("int").alias("OrderDate_SK"),
        F.lit(1).cast("long").alias("Currency_SK"), pick(5).alias("Location_SK"), pick(5).alias("Territory_SK"),
        (F.col("id") % 100).cast("decimal(18,2)").alias("SubTotal"))
    lines = spark.range(n * 2).select(
        F.col("id").alias("SalesID"), (F.col("id") % n).alias("OrderID"), pick(200).alias("Product_SK"),
        (F.col("id") % 7 + 1).cast("int").alias("OrderQty"), (F.col("id") % 90).cast("decimal(18,4)").alias("LineTotal"))
    return {
        "fact_sales_order": orders, "fact_sales_order_detail": lines,
        "fact_purchases": lines.withColumnRenamed("SalesID", "PurchaseID").withColumn("OrderDate_SK", F.lit(20230105)),
        "dim_product": spark.range(1, 201).select(
            F.col("id").alias("Product_SK"), F.col("id").alias("ProductID"), F.concat(F.lit("p-"), "id").alias("ProductName"),
            (F.col("id") % 4).cast("string").alias("Category"), (F.col("id") % 9).cast("string").alias("SubCategory"),
            F.lit(Decimal("7.5")).alias("StandardCost"), (F.col("id") % 2).cast("int").alias("FinishedGoodsFlag")),
        "dim_location": spark.range(1, 6).select(
            F.col("id").alias("Location_SK"), F.lit("c").alias("City"), F.lit("s").alias("StateProvinceName"), F.lit("n").alias("CountryName")),
        "dim_territory": spark.range(1, 6).select(
            F.col("id").alias("Territory_SK"), F.concat(F.lit("t"), "id").alias("TerritoryName"), F.lit("g").alias("TerritoryGroup")),
        "dim_currency": spark.range(1, 2).select(F.col("id").alias("Currency_SK"), F.lit("USD").alias("ToCurrencyCode")),
        "dim_customer": spark.range(1, 51).select(F.col("id").alias("Customer_SK"), F.lit("PERSON").alias("CustomerType")),
        "dim_date": dims.dim_date(spark, "2023-01-01", "2023-12-31"),
    }


@pytest.mark.parametrize("build", [
    gold.profitability, lambda t: measures.line_measures(measures.sold_lines(t), "ProductName"), measures.date_drill,
    features.demand_product_daily, features.customer_daily, features.inventory_product_daily, features.product_insights_daily,
    features.product_region_daily, features.customer_first_days], ids=[
    "profitability", "product_measures", "date_drill", "demand", "customers", "inventory", "insights", "regions", "first_days"])
def test_split_joins_give_the_same_rows(spark, rows, star, build):
    plain = rows(build(star))
    with settings(spark, SPLITTING):
        assert rows(build(star)) == plain
    assert plain


def test_hot_lookup_side_is_split_and_whole(spark):
    fact = spark.range(60000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dim = spark.range(60000).select((F.col("id") + 1).alias("sk"), F.col("id").alias("k"))
    with settings(spark, SPLITTING):
        out = lookup_sk(fact.repartition(8), dim, "k", "k", "sk", "s")
        got = out.agg(F.count("s"), F.sum(F.col("s") - F.col("k"))).collect()
        assert tuple(got[0]) == (60000, 60000)
        plan = out._jdf.queryExecution().executedPlan()
        out.collect()
        assert "skew=true" in plan.toString()


def test_hot_key_dedup_moves_one_row_per_task(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    out = dedup(df, ["k"], ["id"])
    assert out.count() == 20001
    assert out.filter("k = -1").first().id == 0


def test_duplicates_of_a_hot_value(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    assert duplicate_checks(df, ["k"]).first().FailedRows == 2999
