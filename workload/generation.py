"""Generated tables whose size follows the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources import generate, tables
from workload.registry import query

AS_OF = "2024-06-30 12:00:00"
NOW = f"TIMESTAMP '{AS_OF}'"
B = 1000
CODES = "[" + ", ".join(f"'{c}'" for c in generate.COUNTRIES) + "]"
ACTORS = "[" + ", ".join(f"'{a}'" for a in generate.ACTORS) + "]"


def _ids(spark: SparkSession, folder: str, table: str, key: str, copies: int = 1) -> DataFrame:
    """``copies`` numbers per row of a given table."""
    rows = tables.table(spark, folder, table).select(F.col(key).alias("key"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return rows.select("key", copy.alias("copy")).select((F.col("key") * copies + F.col("copy")).alias("id"))


def _numbers(table: str, key: str, copies: int = 1) -> str:
    return (f"(SELECT id % {B} + 1 AS n, id - id % {B} AS inserted FROM (SELECT {key} * {copies} + copy AS id "
            f"FROM {table}, (SELECT unnest(range({copies})) AS copy)))")


def _exact(number: str, divisor: int, kind: str) -> str:
    """Division in whole thousandths, so no binary fraction is involved."""
    return f"CAST(CAST(({number}) * {1000 // divisor} AS DECIMAL(18,3)) * 0.001 AS {kind})"


PRICE = "CAST(CAST(((n * 503 + 199) % 99900) * 10 AS DECIMAL(18,3)) * 0.001 + 1.99 AS DECIMAL(10,2))"


@query("gen_customers", f"""
SELECT inserted + n AS "CustomerID", 'user' || (inserted + n) || '@domain' || (n % 7) || '.com' AS "Email",
       'Customer Name ' || (inserted + n) AS "FullName", {CODES}[n % 16 + 1] AS "Country",
       'Region ' || (n % 50) AS "Region", 'City ' || (n % 500) AS "City",
       {NOW} - INTERVAL 1 DAY - to_days(CAST(n % 2190 AS INTEGER)) AS "SignupDate",
       CAST(1 + n % 3 AS TINYINT) AS "Status", {_exact('(n * 17 + 523) % 500000', 100, 'DECIMAL(12,2)')} AS "CreditLimit",
       CASE WHEN n % 10 < 3 THEN NULL ELSE CAST(1 + n % 5 AS TINYINT) END AS "LoyaltyTier"
FROM {_numbers('customer', 'c_custkey')}""")
def gen_customers(spark: SparkSession, folder: str) -> DataFrame:
    return generate.customers(_ids(spark, folder, "customer", "c_custkey"), AS_OF, B)


@query("gen_products", f"""
SELECT inserted + n AS "ProductID", 'SKU-' || lpad(CAST(inserted + n AS VARCHAR), 10, '0') AS "SKU",
       'Product ' || (inserted + n) AS "ProductName", (n * 31 + 7) % 50 + 1 AS "CategoryID",
       {PRICE} AS "UnitPrice",
       CAST(CAST(((n * 503 + 199) % 99900) * 5 AS DECIMAL(18,3)) * 0.001 + 0.99 AS DECIMAL(10,2)) AS "CostPrice",
       n % 20 <> 0 AS "IsActive", {_exact('(n * 13 + 77) % 50000', 1000, 'DECIMAL(8,3)')} AS "Weight",
       {NOW} - INTERVAL 1 DAY - to_days(CAST(n % 1825 AS INTEGER)) AS "CreatedDate"
FROM {_numbers('part', 'p_partkey')}""")
def gen_products(spark: SparkSession, folder: str) -> DataFrame:
    return generate.products(_ids(spark, folder, "part", "p_partkey"), AS_OF, batch=B)


@query("gen_category_sizes", f"""
SELECT [{', '.join("'" + c.replace("'", "''") + "'" for c in generate.CATEGORIES)}][(n * 31 + 7) % 50 + 1] AS "CategoryName",
       count(*) AS products
FROM {_numbers('part', 'p_partkey')} GROUP BY ALL""")
def gen_category_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return (gen_products(spark, folder).join(generate.categories(spark), "CategoryID")
            .groupBy("CategoryName").agg(F.count("*").alias("products")))


@query("gen_orders", f"""
SELECT inserted + n AS "OrderID", (n * 7919 + inserted * 3571) % 1000000 + 1 AS "CustomerID",
       {NOW} - to_minutes((n * 7 + inserted * 11) % 1576800) AS "OrderDate",
       CAST(CASE WHEN n % 100 < 55 THEN 4 WHEN n % 100 < 85 THEN 3 WHEN n % 100 < 95 THEN 2 WHEN n % 100 < 98 THEN 5
                 ELSE 1 END AS TINYINT) AS "Status",
       CAST({_exact('(n * 7933 + 271) % 500000', 100, 'DECIMAL(12,2)')} + 10 AS DECIMAL(12,2)) AS "TotalAmount",
       {CODES}[n % 16 + 1] AS "ShippingCountry", CAST(1 + n % 4 AS TINYINT) AS "PaymentMethod",
       CAST(1 + n % 10 AS INTEGER) AS "WarehouseID"
FROM {_numbers('orders', 'o_orderkey')}""")
def gen_orders(spark: SparkSession, folder: str) -> DataFrame:
    return generate.orders(_ids(spark, folder, "orders", "o_orderkey"), AS_OF, batch=B)


@query("gen_order_items", f"""
SELECT inserted + n AS "OrderItemID", (n * 6343 + inserted * 2713) % 5000000 + 1 AS "OrderID",
       (n * 7103 + inserted * 1399) % 500000 + 1 AS "ProductID", CAST(1 + n % 10 AS INTEGER) AS "Quantity",
       {PRICE} AS "UnitPrice", CAST(CASE WHEN n % 7 = 0 THEN n % 50 ELSE 0 END AS DECIMAL(5,2)) AS "Discount",
       CAST(CAST(1 + n % 10 AS DECIMAL(4,0)) * {PRICE}
            * CAST(100 - CASE WHEN n % 7 = 0 THEN n % 50 ELSE 0 END AS DECIMAL(5,2)) * 0.01 AS DECIMAL(12,2)) AS "LineTotal"
FROM {_numbers('orders', 'o_orderkey', 3)}""")
def gen_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return generate.order_items(_ids(spark, folder, "orders", "o_orderkey", 3), batch=B)


@query("gen_inventory", f"""
SELECT inserted + n AS "InventoryID", (n * 7103 + inserted * 1399) % 500000 + 1 AS "ProductID",
       CAST(1 + n % 10 AS INTEGER) AS "WarehouseID", CAST(50 + n % 950 AS INTEGER) AS "QuantityOnHand",
       CAST(CASE WHEN n % 5 < 2 THEN 20 ELSE 50 END AS INTEGER) AS "ReorderLevel",
       {NOW} - to_days(CAST(CASE WHEN n % 3 = 0 THEN n % 60 ELSE n % 180 END AS INTEGER)) AS "LastRestockDate"
FROM {_numbers('part', 'p_partkey', 4)}""")
def gen_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return generate.inventory(_ids(spark, folder, "part", "p_partkey", 4), AS_OF, batch=B)


@query("gen_order_history", f"""
SELECT inserted + n AS "HistoryID", (n * 6343 + inserted * 2713) % 5000000 + 1 AS "OrderID",
       CAST(CASE WHEN n % 5 = 0 THEN NULL ELSE n % 5 END AS TINYINT) AS "OldStatus",
       CAST(n % 5 + 1 AS TINYINT) AS "NewStatus", {ACTORS}[n % 6 + 1] AS "ChangedBy",
       {NOW} - to_minutes((n * 13 + 7) % 1576800) AS "ChangeDate",
       CASE WHEN n % 3 = 0 THEN 'Status transition for order batch ' || (n % 1000) END AS "Notes"
FROM {_numbers('orders', 'o_orderkey', 4)}""")
def gen_order_history(spark: SparkSession, folder: str) -> DataFrame:
    return generate.order_history(_ids(spark, folder, "orders", "o_orderkey", 4), AS_OF, batch=B)
