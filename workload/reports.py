"""Sales, search and audit reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import layout, reports
from ledgerloom.plans.layout import write_sorted
from ledgerloom.session import fresh_path
from ledgerloom.sources import tables
from workload.registry import ORACLE, query

YEAR = ("2000-01-01", "2001-01-01")
AS_OF = "2001-08-01"

ITEMS = """
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(12,2)) AS line_total
  FROM lineitem),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category_name,
         CAST(split_part(p_brand, '#', 2) AS INTEGER) AS category_id
  FROM part)"""


@query("monthly_sales", f"""
WITH {ITEMS}
SELECT category_id, category_name, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month,
       CAST(sum(line_total) AS DECIMAL(38,2)) AS total_sales, count(DISTINCT o_orderkey) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS units_sold
FROM orders JOIN items ON o_orderkey = order_id JOIN products USING (product_id)
WHERE o_orderdate >= TIMESTAMP '{YEAR[0]}' AND o_orderdate < TIMESTAMP '{YEAR[1]}'
GROUP BY ALL ORDER BY order_year, order_month, category_id""")
def monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_sales(tables.orders(spark, folder), tables.items(spark, folder),
                                 tables.products(spark, folder), tables.categories(spark, folder), *YEAR)


@query("top3_per_category", f"""
WITH {ITEMS},
sold AS (
  SELECT category_id, category_name, product_id, product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity,
         CAST(sum(line_total) AS DECIMAL(38,2)) AS total_revenue
  FROM orders JOIN items ON o_orderkey = order_id JOIN products USING (product_id)
  WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 3 MONTH GROUP BY ALL)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY category_id ORDER BY total_quantity DESC, product_id) AS INTEGER) AS rank_num
  FROM sold) WHERE rank_num <= 3""")
def top3_per_category(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_products(tables.orders(spark, folder), tables.items(spark, folder),
                                tables.products(spark, folder), tables.categories(spark, folder), AS_OF)


@query("text_contains", """
SELECT p_partkey AS product_id, p_name AS product_name, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS category_id
FROM part WHERE p_name ILIKE '%RING%'""")
def text_contains(spark: SparkSession, folder: str) -> DataFrame:
    return reports.text_search(tables.products(spark, folder), "product_name", "Ring")


# One address per page: the page as user at the host of its URL; the URL itself where the
# page number is a multiple of ten, so that an address without "@" occurs too.
ADDRESSES = """
SELECT page_id, CASE WHEN page_id % 10 = 0 THEN url
                     ELSE 'Page' || page_id || '@' || upper(split_part(url, '/', 3)) END AS email
FROM {pages}"""


@query("domain_extract", f"""
SELECT page_id, email, lower(substr(email, strpos(email, '@') + 1)) AS email_domain
FROM ({ADDRESSES.format(pages="pages")})""")
def domain_extract(spark: SparkSession, folder: str) -> DataFrame:
    addresses = spark.sql(ADDRESSES, pages=tables.table(spark, folder, "pages"))
    return reports.with_domain(addresses, "email")


@query("domain_search", f"""
SELECT page_id, email, lower(substr(email, strpos(email, '@') + 1)) AS email_domain
FROM ({ADDRESSES.format(pages="pages")}) WHERE lower(substr(email, strpos(email, '@') + 1)) LIKE 'm.%'""")
def domain_search(spark: SparkSession, folder: str) -> DataFrame:
    return reports.domain_search(domain_extract(spark, folder), "M.")


@query("domain_search_stored", ORACLE["domain_search"])
def domain_search_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The search column written once, sorted, so that a prefix skips most of the files."""
    path = fresh_path(spark)
    write_sorted(domain_extract(spark, folder), path, ["email_domain"])
    return reports.domain_search(spark.read.parquet(path), "M.")


@query("orders_by_status", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderpriority AS shipping_country
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC""")
def orders_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return reports.orders_by_status(tables.orders(spark, folder), "F")


@query("audit_range", """
SELECT event_id AS history_id, user_id AS order_id, event_type AS changed_by, ts AS change_date, props AS notes
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' ORDER BY ts DESC""")
def audit_range(spark: SparkSession, folder: str) -> DataFrame:
    return reports.audit_range(tables.history(spark, folder), "2024-01-05", "2024-01-20")


@query("audit_by_actor", """
SELECT event_type AS changed_by, count(*) AS total_changes, min(ts) AS first_change, max(ts) AS last_change
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'
GROUP BY event_type ORDER BY total_changes DESC""")
def audit_by_actor(spark: SparkSession, folder: str) -> DataFrame:
    return reports.audit_by_actor(tables.history(spark, folder), "2024-01-01", "2025-01-01")


# The numeric columns of the tables that the sales reports join.
NUMERIC = {"orders": ["o_orderkey", "o_custkey", "o_totalprice"],
           "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
           "part": ["p_partkey", "p_size", "p_retailprice"], "customer": ["c_custkey", "c_nationkey", "c_acctbal"]}


@query("column_statistics", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
               CAST(min({c}) AS DOUBLE) + 0 AS lowest, CAST(max({c}) AS DOUBLE) + 0 AS highest FROM {t}""" for t, columns in NUMERIC.items() for c in columns))
def column_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """What the catalogue knows of the report tables after they were analyzed."""
    database = f"statistics_{uuid.uuid4().hex[:12]}"
    names = layout.catalogue(spark, database, {t: f"{folder}/{t}.parquet" for t in NUMERIC})
    found = layout.column_statistics(spark, names).drop("distinct")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found
