"""Sales and audit reports over an order, item, product, category and history model.

Frames carry the columns ``order_id, customer_id, order_date, status, total_amount`` (orders),
``order_id, product_id, quantity, line_total`` (items), ``product_id, product_name,
category_id`` (products), ``category_id, category_name`` (categories), ``changed_by,
change_date`` (history).
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.cleaning import email_domain


def between(column: str, start: datetime | str, end: datetime | str) -> Column:
    """Half-open range; the bounds are constants, so the scan prunes on them."""
    low, high = (F.lit(str(b)).cast("timestamp_ntz") for b in (start, end))
    return (F.col(column) >= low) & (F.col(column) < high)


def months_before(as_of: datetime | str, months: int) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz") - F.make_ym_interval(F.lit(0), F.lit(months))


def _units(items: DataFrame, column: str) -> Column:
    """A money column as whole units of its scale. Sums of longs stay in registers where sums
    of wide decimals allocate, and ANSI arithmetic would raise rather than overflow."""
    return (F.col(column) * F.lit(10 ** items.schema[column].dataType.scale)).cast("bigint")


def _money(units: Column, items: DataFrame, column: str) -> Column:
    scale = items.schema[column].dataType.scale
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})")
    return (units.cast("decimal(20,0)") * unit).cast(f"decimal(38,{scale})")


def monthly_sales(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame,
                  start: datetime | str, end: datetime | str) -> DataFrame:
    """Sales, distinct orders and units per category and month.

    Items get their narrow category first and meet the orders last, so they are shuffled by
    order once, and the sum per order and category uses that. It leaves one row per order
    there, so the distinct count becomes a plain count, and an order with a great many items
    shrinks to a row per category before anything is grouped by month. The month follows from
    the order, so it is carried along and not grouped by.
    """
    month = F.year("order_date") * 12 + F.month("order_date") - 1
    in_range = orders.filter(between("order_date", start, end)).select("order_id", month.alias("month"))
    sold = items.select("order_id", "product_id", _units(items, "line_total").alias("units"), "quantity")
    per_order = (
        sold.join(products.select("product_id", "category_id"), "product_id").drop("product_id")
        .join(in_range, "order_id")
        .groupBy("order_id", "category_id")
        .agg(F.max("month").alias("month"), F.sum("units").alias("units"), F.sum("quantity").alias("quantity"))
    )
    return (
        per_order.groupBy("category_id", "month")
        .agg(_money(F.sum("units"), items, "line_total").alias("total_sales"), F.count("*").alias("order_count"),
             F.sum("quantity").alias("units_sold"))
        .withColumns({"order_year": F.floor(F.col("month") / 12).cast("int"), "order_month": (F.col("month") % 12 + 1).cast("int")})
        .join(categories.select("category_id", "category_name"), "category_id")
        .select("category_id", "category_name", "order_year", "order_month", "total_sales", "order_count", "units_sold")
        .orderBy("order_year", "order_month", "category_id")
    )


def top_products(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame,
                 as_of: datetime | str, months: int = 3, k: int = 3) -> DataFrame:
    """The ``k`` best sold products of each category in the months before ``as_of``.

    Items are summed per product before product names are joined; equal quantities rank by
    product id. The rank filter is pushed below the window's shuffle as a group limit.
    """
    recent = orders.filter(F.col("order_date") >= months_before(as_of, months)).select("order_id")
    per_product = (
        items.select("order_id", "product_id", "quantity", "line_total")
        .join(recent, "order_id").groupBy("product_id")
        .agg(F.sum("quantity").alias("total_quantity"),
             _money(F.sum(_units(items, "line_total")), items, "line_total").alias("total_revenue"))
    )
    by_quantity = Window.partitionBy("category_id").orderBy(F.desc("total_quantity"), "product_id")
    return (
        per_product.join(products.select("product_id", "product_name", "category_id"), "product_id")
        .withColumn("rank_num", F.row_number().over(by_quantity))
        .filter(F.col("rank_num") <= k)
        .join(categories.select("category_id", "category_name"), "category_id")
        .select("category_id", "category_name", "rank_num", "product_id", "product_name", "total_quantity",
                "total_revenue")
        .orderBy("category_id", "rank_num")
    )


def text_search(rows: DataFrame, column: str, needle: str) -> DataFrame:
    """Rows whose text contains ``needle``, whatever the case."""
    return rows.filter(F.contains(F.lower(F.col(column)), F.lit(needle.lower())))


def with_domain(rows: DataFrame, email: str, domain: str = "email_domain") -> DataFrame:
    """Add the stored search column; written once, it lets prefix searches prune row groups."""
    return rows.withColumn(domain, email_domain(F.col(email)))


def domain_search(rows: DataFrame, prefix: str, domain: str = "email_domain") -> DataFrame:
    return rows.filter(F.col(domain).startswith(prefix.lower()))


def orders_by_status(orders: DataFrame, status: str | int) -> DataFrame:
    """Orders in one status, latest first; the parameter never becomes part of the SQL text."""
    return orders.sparkSession.sql(
        "SELECT order_id, customer_id, order_date, total_amount, shipping_country FROM {orders} "
        "WHERE status = :status ORDER BY order_date DESC", args={"status": status}, orders=orders)


def audit_range(history: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    return history.filter(between("change_date", start, end)).orderBy(F.desc("change_date"))


def audit_by_actor(history: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    return (
        history.filter(between("change_date", start, end)).groupBy("changed_by")
        .agg(F.count("*").alias("total_changes"), F.min("change_date").alias("first_change"),
             F.max("change_date").alias("last_change"))
        .orderBy(F.desc("total_changes"))
    )
