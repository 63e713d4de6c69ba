from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import layout, reports
from ledgerloom.sources import generate
from ledgerloom.sources.schemas import SHOP, shop_schema

AS_OF = datetime(2024, 6, 30, 12)


def test_generators_follow_their_schemas(spark, tmp_path):
    rows = {"Customers": 300, "Products": 200, "Orders": 500, "OrderItems": 900, "Inventory": 400, "OrderHistory": 700}
    generate.write_all(spark, str(tmp_path), AS_OF, rows)
    for name in SHOP:
        df = spark.read.parquet(str(tmp_path / name))
        assert df.count() == (50 if name == "Categories" else rows[name])
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in shop_schema(name)]


def test_formulas_restart_with_every_batch(spark):
    got = {r.CustomerID: r for r in generate.customers(generate.series(spark, 25), AS_OF, batch=10).collect()}
    assert sorted(got) == list(range(1, 26))
    assert got[13].Email == "user13@domain3.com" and got[3].Email == "user3@domain3.com"
    assert got[13].Country == got[3].Country == "UK" and got[13].LoyaltyTier == 4
    assert got[1].LoyaltyTier is None and got[1].CreditLimit == Decimal("5.40")
    assert got[2].SignupDate == datetime(2024, 6, 27, 12)


def test_line_total(spark):
    row = generate.order_items(generate.series(spark, 7), batch=100).filter("OrderItemID = 7").first()
    price = Decimal((7 * 503 + 199) % 99900) / 100 + Decimal("1.99")
    assert (row.Quantity, row.UnitPrice, row.Discount) == (8, price, Decimal(7))
    assert row.LineTotal == (8 * price * Decimal("0.93")).quantize(Decimal("0.01"))


def test_reports_on_generated_tables(spark):
    orders = generate.orders(generate.series(spark, 2000), AS_OF, 100, batch=500).selectExpr(
        "OrderID order_id", "CustomerID customer_id", "OrderDate order_date", "Status status",
        "TotalAmount total_amount", "ShippingCountry shipping_country")
    items = generate.order_items(generate.series(spark, 6000), 2000, 100, batch=500).selectExpr(
        "OrderID order_id", "ProductID product_id", "Quantity quantity", "LineTotal line_total")
    products = generate.products(generate.series(spark, 100), AS_OF).selectExpr(
        "ProductID product_id", "ProductName product_name", "CategoryID category_id")
    categories = generate.categories(spark).selectExpr("CategoryID category_id", "CategoryName category_name")
    sales = reports.monthly_sales(orders, items, products, categories, "2024-01-01", "2025-01-01")
    in_year = orders.filter("year(order_date) = 2024").join(items, "order_id").join(products, "product_id")
    assert sales.agg(F.sum("units_sold")).first()[0] == in_year.agg(F.sum("quantity")).first()[0]
    assert sales.agg(F.sum("order_count")).first()[0] == in_year.select("order_id", "category_id").distinct().count()
    top = reports.top_products(orders, items, products, categories, AS_OF)
    assert top.groupBy("category_id").count().agg(F.max("count")).first()[0] <= 3
    plan = top._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    assert reports.orders_by_status(orders, 4).count() == orders.filter("status = 4").count()


def test_rolling_window_clamps_to_the_end_of_the_month(spark):
    got = spark.range(1).select(reports.months_before("2024-05-31 10:00:00", 3)).first()[0]
    assert got == datetime(2024, 2, 29, 10)


@pytest.fixture
def history(spark):
    return generate.order_history(generate.series(spark, 3000), AS_OF, batch=3000)


def test_old_months_move_to_the_archive(spark, history, tmp_path):
    active, archive = str(tmp_path / "active"), str(tmp_path / "archive")
    recent = history.withColumn("ChangeDate", F.expr("timestampadd(DAY, -HistoryID % 150, timestamp_ntz'2024-06-30')"))
    layout.write_by_month(recent, active, "ChangeDate")
    before = layout.months(spark, active)
    moved = layout.archive_months(spark, active, archive, date(2024, 4, 1))
    assert moved and all(m < (2024, 4) for m in moved)
    assert layout.months(spark, archive) == moved and layout.months(spark, active) == [m for m in before if m not in moved]
    schema = shop_schema("OrderHistory")
    kept = layout.read_months(spark, active, schema)
    assert kept.filter("ChangeDate < timestamp_ntz'2024-04-01'").count() == 0
    assert kept.count() + layout.read_months(spark, archive, schema).count() == 3000
    assert layout.archive_months(spark, active, archive, date(2024, 4, 1)) == []


def test_month_folders_prune(spark, history, tmp_path):
    layout.write_by_month(history, str(tmp_path / "h"), "ChangeDate")
    df = layout.read_months(spark, str(tmp_path / "h"), shop_schema("OrderHistory")).filter("year = 2024 AND month = 6")
    assert "PartitionFilters: [isnotnull(year" in df._jdf.queryExecution().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    layout.create_tables(spark, "shop_test", "shop")
    layout.create_tables(spark, "shop_test", "shop")
    assert spark.table("shop_test.Orders").columns[0] == "OrderID"
    orders = generate.orders(generate.series(spark, 500), AS_OF)
    items = generate.order_items(generate.series(spark, 1500), 500, 100)
    layout.write_bucketed(orders, "orders_bucketed", "OrderID", 4)
    layout.write_bucketed(items, "items_bucketed", "OrderID", 4)
    layout.analyze(spark, ["orders_bucketed"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("items_bucketed").join(spark.table("orders_bucketed"), "OrderID")
        assert joined.count() == 1500
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("orders_bucketed", "items_bucketed"):
            spark.sql(f"DROP TABLE {name}")
        spark.sql("DROP DATABASE shop_test CASCADE")


def test_sorted_files(spark, tmp_path):
    orders = generate.orders(generate.series(spark, 500), AS_OF)
    layout.write_sorted(orders, str(tmp_path / "o"), ["OrderDate"])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 500


def test_statistics_are_known_after_analyzing_only(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "IF(id % 4 = 0, NULL, id * 0.5D) AS half", "'x' AS text")
    rows.write.parquet(str(tmp_path / "t"))
    names = layout.catalogue(spark, "statistics_test", {"t": str(tmp_path / "t")})
    found = {r.column: r for r in layout.column_statistics(spark, names).collect()}
    assert set(found) == {"id", "half"}
    assert (found["id"].rows, found["id"].nulls, found["id"].lowest, found["id"].highest) == (100, 0, 0.0, 99.0)
    assert (found["half"].nulls, found["half"].lowest, found["half"].highest) == (25, 0.5, 49.5)
    assert 90 <= found["id"].distinct <= 110
    spark.sql(f"CREATE TABLE statistics_test.fresh USING parquet LOCATION '{tmp_path / 't'}'")
    fresh = layout.column_statistics(spark, ["statistics_test.fresh"]).collect()
    assert all(r.rows is None and r.nulls is None and r.lowest is None for r in fresh)
    spark.sql("DROP DATABASE statistics_test CASCADE")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
