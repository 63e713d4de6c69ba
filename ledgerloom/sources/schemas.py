"""Target tables: the star schema of the consolidation and the order-processing model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values. table -> columns in order, without the audit columns; "!" marks NOT NULL.
STAR = {
    "Customers": "customer_id bigint!, customer_code string!, first_name string!, last_name string!, "
                 "full_name string, email string!, phone string, address string, city string, country string, "
                 "tax_id string, registration_date date!, credit_limit decimal(18,2), is_active boolean!",
    "Suppliers": "supplier_id bigint!, supplier_code string!, company_name string!, contact_name string, "
                 "email string!, phone string, address string, city string, country string, tax_id string, "
                 "payment_terms string, is_active boolean!",
    "Products": "product_id bigint!, product_code string!, product_name string!, category string, "
                "unit_price decimal(18,4)!, supplier_id bigint, supplier_code string, sku string, "
                "description string, uom string, is_active boolean!, created_date date",
    "Invoices": "invoice_id bigint!, invoice_number string!, customer_id bigint, customer_code string, "
                "invoice_date date!, due_date date, subtotal decimal(18,4)!, tax_amount decimal(18,4)!, "
                "total_amount decimal(18,4)!, status string!, payment_method string",
    "InvoiceLines": "line_id bigint!, invoice_id bigint!, product_id bigint, product_code string, "
                    "quantity decimal(18,4)!, unit_price decimal(18,4)!, line_total decimal(18,4)!, "
                    "discount_pct decimal(5,2)",
    "Payments": "payment_id bigint!, payment_number string!, invoice_id bigint, invoice_code string, "
                "payment_date date!, amount decimal(18,4)!, payment_method string, reference_number string, "
                "status string!",
}
PROVENANCE = "source_system string!, source_id string!"
AUDIT = "created_at timestamp, updated_at timestamp"

SHOP = {
    "Customers": "CustomerID bigint!, Email string!, FullName string!, Country string!, Region string, City string, "
                 "SignupDate timestamp_ntz!, Status tinyint!, CreditLimit decimal(12,2), LoyaltyTier tinyint",
    "Categories": "CategoryID bigint!, CategoryName string!, IsActive boolean!",
    "Products": "ProductID bigint!, SKU string!, ProductName string!, CategoryID bigint!, UnitPrice decimal(10,2)!, "
                "CostPrice decimal(10,2)!, IsActive boolean!, Weight decimal(8,3), CreatedDate timestamp_ntz!",
    "Orders": "OrderID bigint!, CustomerID bigint!, OrderDate timestamp_ntz!, Status tinyint!, "
              "TotalAmount decimal(12,2)!, ShippingCountry string!, PaymentMethod tinyint!, WarehouseID int!",
    "OrderItems": "OrderItemID bigint!, OrderID bigint!, ProductID bigint!, Quantity int!, UnitPrice decimal(10,2)!, "
                  "Discount decimal(5,2)!, LineTotal decimal(12,2)!",
    "Inventory": "InventoryID bigint!, ProductID bigint!, WarehouseID int!, QuantityOnHand int!, ReorderLevel int!, "
                 "LastRestockDate timestamp_ntz",
    "OrderHistory": "HistoryID bigint!, OrderID bigint!, OldStatus tinyint, NewStatus tinyint!, ChangedBy string!, "
                    "ChangeDate timestamp_ntz!, Notes string",
}


def column_types(definition: str) -> dict[str, str]:
    """Column name to type text, in order."""
    return dict(part.split(" ", 1) for part in definition.split(", "))


def _schema(definition: str) -> T.StructType:
    fields = []
    for name, kind in column_types(definition).items():
        plain = T.StructType.fromDDL(f"{name} {kind.rstrip('!')}")[0]
        fields.append(T.StructField(name, plain.dataType, not kind.endswith("!")))
    return T.StructType(fields)


def star_schema(table: str) -> T.StructType:
    return _schema(f"{STAR[table]}, {PROVENANCE}, {AUDIT}")


def shop_schema(table: str) -> T.StructType:
    return _schema(SHOP[table])


def shape(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the target's order and type; money is rounded to the target scale here only."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def not_null_violations(df: DataFrame, schema: T.StructType) -> Column:
    """How many required columns of a row are NULL."""
    return sum((F.col(f.name).isNull().cast("int") for f in schema.fields if not f.nullable), F.lit(0))
