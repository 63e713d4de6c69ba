"""Times the sales and audit reports on generated tables of the published size.

    python bench_shop.py FOLDER [SHARE]

generates the tables into FOLDER unless they are there (SHARE scales them, 1 by default:
1M customers, 5M orders, 15M items, 20M history rows) and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerloom.plans import layout, reports  # noqa: E402
from ledgerloom.sources import generate  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

AS_OF = "2025-06-30 12:00:00"


def read(spark: SparkSession, folder: str, table: str, names: dict[str, str]) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}").select(*[F.col(k).alias(v) for k, v in names.items()])


def main() -> None:
    folder, share = sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 1.0
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    SparkSession.builder.config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    spark = local_session(cpus, shuffle_partitions=int(cpus), memory="16g")
    started = time.perf_counter()
    if not Path(folder, "OrderHistory").exists():
        generate.write_all(spark, folder, AS_OF, {k: int(v * share) for k, v in generate.ROWS.items()})
    generated = time.perf_counter() - started

    orders = read(spark, folder, "Orders", {
        "OrderID": "order_id", "CustomerID": "customer_id", "OrderDate": "order_date", "Status": "status",
        "TotalAmount": "total_amount", "ShippingCountry": "shipping_country"})
    items = read(spark, folder, "OrderItems", {
        "OrderID": "order_id", "ProductID": "product_id", "Quantity": "quantity", "LineTotal": "line_total"})
    products = read(spark, folder, "Products", {
        "ProductID": "product_id", "ProductName": "product_name", "CategoryID": "category_id"})
    categories = read(spark, folder, "Categories", {"CategoryID": "category_id", "CategoryName": "category_name"})
    history = read(spark, folder, "OrderHistory", {
        "HistoryID": "history_id", "OrderID": "order_id", "ChangedBy": "changed_by", "ChangeDate": "change_date",
        "Notes": "notes"})
    customers = spark.read.parquet(f"{folder}/Customers")
    for name, rows in (("orders", orders), ("items", items)):
        layout.write_bucketed(rows, f"bucketed_{name}", "order_id", int(cpus))
    by_order = [spark.table("bucketed_orders"), spark.table("bucketed_items")]
    queries = {
        "monthly_sales_bucketed": lambda: reports.monthly_sales(*by_order, products, categories, "2024-01-01", "2025-01-01"),
        "top3_per_category_bucketed": lambda: reports.top_products(*by_order, products, categories, AS_OF),
        "monthly_sales": lambda: reports.monthly_sales(orders, items, products, categories, "2024-01-01", "2025-01-01"),
        "top3_per_category": lambda: reports.top_products(orders, items, products, categories, AS_OF),
        "email_contains": lambda: reports.text_search(customers, "Email", "gmail"),
        "orders_by_status_1": lambda: reports.orders_by_status(orders, 1),
        "orders_by_status_4": lambda: reports.orders_by_status(orders, 4),
        "audit_range": lambda: reports.audit_range(history, "2024-01-01", "2024-07-01"),
        "audit_by_actor": lambda: reports.audit_by_actor(history, "2024-01-01", "2025-01-01"),
    }
    seconds = {}
    for name, build in queries.items():
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "shop_reports_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "generated_sec": round(generated, 1), "share": share}))
    spark.stop()


if __name__ == "__main__":
    main()
