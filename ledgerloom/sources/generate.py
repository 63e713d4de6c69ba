"""Deterministic test data for the order-processing model.

A generator turns a series, any frame with a number ``id`` from 0 on, into a table. The
formulas work on the number within a batch (``n``, from 1) and on how many rows came before
the batch (``inserted``), so they repeat from batch to batch as the originals do. Dates are
counted back from ``as_of``, which is always given.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import shape, shop_schema

# Fixed values.
COUNTRIES = ["US", "MX", "CA", "UK", "DE", "FR", "ES", "BR", "AR", "CO", "PE", "CL", "JP", "AU", "IT", "NL"]
CATEGORIES = [
    "Electronics", "Clothing", "Home & Garden", "Sports", "Books", "Toys & Games", "Health & Beauty", "Automotive",
    "Food & Beverages", "Office Supplies", "Pet Supplies", "Jewelry", "Music", "Movies", "Tools", "Baby Products",
    "Furniture", "Grocery", "Shoes", "Accessories", "Outdoor", "Kitchen", "Bedding", "Lighting", "Stationery",
    "Cleaning", "Hardware", "Paint", "Garden", "Pool", "Camping", "Fitness", "Bikes", "Gaming", "Software", "Cameras",
    "Phones", "Tablets", "Laptops", "Desktops", "Monitors", "Printers", "Networking", "Storage", "Cables", "Audio",
    "Video", "Wearables", "Drones", "Smart Home",
]
ACTORS = ["system", "warehouse_admin", "shipping_api", "cs_agent", "payment_gateway", "auto_cancel"]
ROWS = {"Customers": 1_000_000, "Products": 500_000, "Orders": 5_000_000, "OrderItems": 15_000_000,
        "Inventory": 2_000_000, "OrderHistory": 20_000_000}
BATCH = 100_000
PRODUCT_BATCH = 50_000
HISTORY_MINUTES = 1_576_800


def _numbers() -> tuple[Column, Column]:
    return F.col("n"), F.col("inserted")


def series(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(rows)


def in_batches(ids: DataFrame, batch: int) -> DataFrame:
    place = F.col("id") % batch
    return ids.select(F.col("id").cast("bigint").alias("id")).select(
        "id", (place + 1).alias("n"), (F.col("id") - place).alias("inserted"))


def _decode(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _moment(as_of: datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _days_before(moment: Column, days: Column) -> Column:
    return moment - F.make_dt_interval(days=days.cast("int"))


def _minutes_before(moment: Column, minutes: Column) -> Column:
    return moment - F.make_dt_interval(mins=minutes.cast("int"))


def _share(number: Column, divisor: int, kind: str) -> Column:
    return (number.cast("decimal(18,0)") / F.lit(divisor).cast("decimal(4,0)")).cast(kind)


def _price(n: Column) -> Column:
    return (_share((n * 503 + 199) % 99900, 100, "decimal(18,6)") + F.lit("1.99").cast("decimal(3,2)")).cast(
        "decimal(10,2)")


def customers(ids: DataFrame, as_of: datetime | str, batch: int = BATCH) -> DataFrame:
    n, inserted = _numbers()
    number = inserted + n
    yesterday = _moment(as_of) - F.make_dt_interval(days=F.lit(1))
    return shape(in_batches(ids, batch).select(
        number.alias("CustomerID"),
        F.concat(F.lit("user"), number, F.lit("@domain"), n % 7, F.lit(".com")).alias("Email"),
        F.concat(F.lit("Customer Name "), number).alias("FullName"),
        _decode(COUNTRIES, n % 16).alias("Country"),
        F.concat(F.lit("Region "), n % 50).alias("Region"),
        F.concat(F.lit("City "), n % 500).alias("City"),
        _days_before(yesterday, n % 2190).alias("SignupDate"),
        (1 + n % 3).alias("Status"),
        _share((n * 17 + 523) % 500000, 100, "decimal(12,2)").alias("CreditLimit"),
        F.when(n % 10 >= 3, 1 + n % 5).alias("LoyaltyTier"),
    ), shop_schema("Customers"))


def categories(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, name, True) for i, name in enumerate(CATEGORIES)]
    return spark.createDataFrame(rows, shop_schema("Categories"))


def products(ids: DataFrame, as_of: datetime | str, category_count: int = len(CATEGORIES),
             batch: int = PRODUCT_BATCH) -> DataFrame:
    n, inserted = _numbers()
    number = inserted + n
    yesterday = _moment(as_of) - F.make_dt_interval(days=F.lit(1))
    cost = _share((n * 503 + 199) % 99900, 200, "decimal(18,6)") + F.lit("0.99").cast("decimal(3,2)")
    return shape(in_batches(ids, batch).select(
        number.alias("ProductID"),
        F.concat(F.lit("SKU-"), F.lpad(number.cast("string"), 10, "0")).alias("SKU"),
        F.concat(F.lit("Product "), number).alias("ProductName"),
        ((n * 31 + 7) % category_count + 1).alias("CategoryID"),
        _price(n).alias("UnitPrice"),
        cost.alias("CostPrice"),
        (n % 20 != 0).alias("IsActive"),
        _share((n * 13 + 77) % 50000, 1000, "decimal(8,3)").alias("Weight"),
        _days_before(yesterday, n % 1825).alias("CreatedDate"),
    ), shop_schema("Products"))


def orders(ids: DataFrame, as_of: datetime | str, customer_count: int = ROWS["Customers"],
           batch: int = BATCH) -> DataFrame:
    n, inserted = _numbers()
    part = n % 100
    status = F.when(part < 55, 4).when(part < 85, 3).when(part < 95, 2).when(part < 98, 5).otherwise(1)
    amount = _share((n * 7933 + 271) % 500000, 100, "decimal(12,2)") + F.lit(10)
    return shape(in_batches(ids, batch).select(
        (inserted + n).alias("OrderID"),
        ((n * 7919 + inserted * 3571) % customer_count + 1).alias("CustomerID"),
        _minutes_before(_moment(as_of), (n * 7 + inserted * 11) % HISTORY_MINUTES).alias("OrderDate"),
        status.alias("Status"),
        amount.alias("TotalAmount"),
        _decode(COUNTRIES, n % 16).alias("ShippingCountry"),
        (1 + n % 4).alias("PaymentMethod"),
        (1 + n % 10).alias("WarehouseID"),
    ), shop_schema("Orders"))


def order_items(ids: DataFrame, order_count: int = ROWS["Orders"], product_count: int = ROWS["Products"],
                batch: int = BATCH) -> DataFrame:
    n, inserted = _numbers()
    percent = F.when(n % 7 == 0, n % 50).otherwise(0)
    quantity = (1 + n % 10).cast("decimal(4,0)")
    kept = F.lit(1) - _share(percent, 100, "decimal(4,2)")
    return shape(in_batches(ids, batch).select(
        (inserted + n).alias("OrderItemID"),
        ((n * 6343 + inserted * 2713) % order_count + 1).alias("OrderID"),
        ((n * 7103 + inserted * 1399) % product_count + 1).alias("ProductID"),
        quantity.alias("Quantity"),
        _price(n).alias("UnitPrice"),
        percent.alias("Discount"),
        (quantity * _price(n) * kept).alias("LineTotal"),
    ), shop_schema("OrderItems"))


def inventory(ids: DataFrame, as_of: datetime | str, product_count: int = ROWS["Products"],
              batch: int = BATCH) -> DataFrame:
    n, inserted = _numbers()
    return shape(in_batches(ids, batch).select(
        (inserted + n).alias("InventoryID"),
        ((n * 7103 + inserted * 1399) % product_count + 1).alias("ProductID"),
        (1 + n % 10).alias("WarehouseID"),
        (50 + n % 950).alias("QuantityOnHand"),
        F.when(n % 5 < 2, 20).otherwise(50).alias("ReorderLevel"),
        _days_before(_moment(as_of), F.when(n % 3 == 0, n % 60).otherwise(n % 180)).alias("LastRestockDate"),
    ), shop_schema("Inventory"))


def order_history(ids: DataFrame, as_of: datetime | str, order_count: int = ROWS["Orders"],
                  batch: int = BATCH) -> DataFrame:
    n, inserted = _numbers()
    step = n % 5
    note = F.concat(F.lit("Status transition for order batch "), n % 1000)
    return shape(in_batches(ids, batch).select(
        (inserted + n).alias("HistoryID"),
        ((n * 6343 + inserted * 2713) % order_count + 1).alias("OrderID"),
        F.when(step > 0, step).alias("OldStatus"),
        (step + 1).alias("NewStatus"),
        _decode(ACTORS, n % 6).alias("ChangedBy"),
        _minutes_before(_moment(as_of), (n * 13 + 7) % HISTORY_MINUTES).alias("ChangeDate"),
        F.when(n % 3 == 0, note).alias("Notes"),
    ), shop_schema("OrderHistory"))


def write_all(spark: SparkSession, out: str, as_of: datetime | str, rows: dict[str, int] = ROWS) -> None:
    """Generate every table; ``rows`` scales them."""
    tables = {
        "Categories": categories(spark),
        "Customers": customers(series(spark, rows["Customers"]), as_of),
        "Products": products(series(spark, rows["Products"]), as_of),
        "Orders": orders(series(spark, rows["Orders"]), as_of, rows["Customers"]),
        "OrderItems": order_items(series(spark, rows["OrderItems"]), rows["Orders"], rows["Products"]),
        "Inventory": inventory(series(spark, rows["Inventory"]), as_of, rows["Products"]),
        "OrderHistory": order_history(series(spark, rows["OrderHistory"]), as_of, rows["Orders"]),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
