"""Stock changes and history retention."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.inventory import apply_deltas, change_stored
from ledgerloom.plans.layout import archive_listed, month_part, split_by_age
from ledgerloom.session import fresh_path
from ledgerloom.sources import tables
from ledgerloom.sources.manifest import StoredTable, hashed_part
from workload.registry import query


INVENTORY_SQL = """
SELECT stock_id, s.product_id, s.warehouse_id, CAST(on_hand + coalesce(d.delta, 0) AS INTEGER) AS on_hand
FROM (SELECT p_partkey * 3 + k AS stock_id, p_partkey AS product_id, CAST(1 + (p_partkey + k) % 2 AS INTEGER) AS warehouse_id,
             50 + p_size * k AS on_hand
      FROM part, (SELECT unnest(range(3)) AS k)) s
LEFT JOIN (SELECT l_partkey AS product_id, CAST(1 + l_suppkey % 2 AS INTEGER) AS warehouse_id,
                  -sum(CAST(l_quantity AS INTEGER)) AS delta
           FROM lineitem GROUP BY ALL) d USING (product_id, warehouse_id)"""


@query("inventory_apply", INVENTORY_SQL)
def inventory_apply(spark: SparkSession, folder: str) -> DataFrame:
    """Three stock rows per part, two of them in one warehouse, less everything sold."""
    return apply_deltas(_stock(spark, folder), _sold(spark, folder), ["product_id", "warehouse_id"], "on_hand", "delta")


def _stock(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    part = tables.table(spark, folder, "part").select("p_partkey", "p_size",
                                                      F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    return part.select((F.col("p_partkey") * 3 + k).alias("stock_id"), F.col("p_partkey").alias("product_id"),
                        (1 + (F.col("p_partkey") + k) % 2).cast("int").alias("warehouse_id"),
                        (50 + F.col("p_size") * k).alias("on_hand"))


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"), (1 + F.col("l_suppkey") % 2).cast("int").alias("warehouse_id"),
        (-F.col("l_quantity").cast("int")).alias("delta"))


STOCK_PARTS = 16


@query("inventory_stored", INVENTORY_SQL)
def inventory_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same stock as a stored table: the sales of every supplier in turn of five change the parts they touch, once each
    though one is sent twice."""
    stock, keys = _stock(spark, folder), ["product_id", "warehouse_id"]
    table = StoredTable(spark, fresh_path(spark), stock.schema)
    table.create(stock, hashed_part(keys, STOCK_PARTS))
    sold = _sold(spark, folder)
    for turn in (0, 1, 2, 3, 4, 4):
        change_stored(table, sold.where(F.col("product_id") % 5 == turn), keys, "on_hand", "delta", STOCK_PARTS, f"turn {turn}")
    return table.read()


@query("archive_roundtrip", """
SELECT CASE WHEN ts < TIMESTAMP '2024-02-01' THEN 'archive' ELSE 'active' END AS tier, event_id AS history_id,
       event_type AS changed_by, ts AS change_date FROM events""")
def archive_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """History stored by month, its old months moved to an archive, and both tiers read back."""
    rows = tables.history(spark, folder).select("history_id", "changed_by", "change_date")
    root = fresh_path(spark)
    table = StoredTable(spark, f"{root}/active", rows.schema)
    table.create(rows, month_part("change_date"))
    archive_listed(table, "change_date", f"{root}/archive", date(2024, 2, 1))
    return reduce(DataFrame.union, [table.read(tier=t).select(F.lit(t).alias("tier"), "*") for t in ("active", "archive")])


@query("history_retention", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'archive' ELSE 'active' END AS tier,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS rows
FROM events GROUP BY ALL""")
def history_retention(spark: SparkSession, folder: str) -> DataFrame:
    labelled = split_by_age(tables.history(spark, folder), "change_date", "2024-01-15")
    return labelled.groupBy("tier", F.year("change_date").alias("year"), F.month("change_date").alias("month")).agg(
        F.count("*").alias("rows"))
