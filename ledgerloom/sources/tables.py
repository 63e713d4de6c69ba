"""The given Parquet tables, and their reading as the order model of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderpriority").alias("shipping_country"))


def _hundredths(column: str) -> Column:
    """A double with two decimals as a whole number, halves away from zero; far cheaper than a
    cast to decimal."""
    return (F.signum(column) * F.floor(F.abs(F.col(column)) * 100 + F.lit(0.5))).cast("bigint")


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with price times (1 - discount), computed in whole numbers and rounded, halves away
    from zero."""
    exact = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))
    half = F.when(F.col("l_extendedprice") < 0, -50).otherwise(50)
    return table(spark, folder, "lineitem").withColumn("_exact", exact + half).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.expr("_exact div 100").cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)"))
        .cast("decimal(12,2)").alias("line_total"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with their brand as category; the brand's number is the category id."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("category_id"))


def categories(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.col("p_brand")
    return table(spark, folder, "part").select(
        F.split_part(brand, F.lit("#"), F.lit(2)).cast("int").alias("category_id"),
        brand.alias("category_name")).distinct()


def history(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream as an audit trail, its event type as the acting party."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("history_id"), F.col("user_id").alias("order_id"),
        F.col("event_type").alias("changed_by"), F.col("ts").alias("change_date"), F.col("props").alias("notes"))
