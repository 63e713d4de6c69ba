"""The thirteen source extracts and how each maps to its target table.

A ``Field`` names the target column, the rule that fills it and the source column it reads;
``extra`` is the rule's own argument, such as a date pattern or a default.
"""

from __future__ import annotations

from dataclasses import dataclass

from ledgerloom.functions.cleaning import DAY_FIRST_DATE, ISO_DATE

SOURCES = ("SOURCE_A", "SOURCE_B", "SOURCE_C")
TABLES = ("Customers", "Suppliers", "Products", "Invoices", "InvoiceLines", "Payments")

# The legacy system is documented as Latin-1; the others write UTF-8.
ENCODINGS = {"SOURCE_A": "UTF-8", "SOURCE_B": "ISO-8859-1", "SOURCE_C": "UTF-8"}


@dataclass(frozen=True)
class Field:
    target: str
    rule: str
    source: str | None = None
    extra: str | None = None


@dataclass(frozen=True)
class Extract:
    source_system: str
    table: str
    path: str
    columns: tuple[str, ...]
    id_column: str
    fields: tuple[Field, ...]

    @property
    def name(self) -> str:
        """``source_a/customers``, the path without its ending."""
        return self.path.removesuffix(".csv")

    def dates(self) -> list[Field]:
        return [f for f in self.fields if f.rule in ("date", "optional_date")]


def _extract(source: str, table: str, path: str, columns: str, fields: list[tuple]) -> Extract:
    names = tuple(columns.split())
    return Extract(source, table, path, names, names[0], tuple(Field(*f) for f in fields))


# The files of the contract, their columns and where each goes.
EXTRACTS = (
    _extract(
        "SOURCE_A", "Customers", "source_a/customers.csv",
        "customer_id first_name last_name email phone address city country registration_date tax_id is_active "
        "credit_limit",
        [("customer_code", "id"), ("first_name", "required", "first_name"), ("last_name", "required", "last_name"),
         ("full_name", "null"), ("email", "email", "email"), ("phone", "optional", "phone"),
         ("address", "optional", "address"), ("city", "optional", "city"), ("country", "optional", "country"),
         ("tax_id", "optional", "tax_id"), ("registration_date", "date", "registration_date", ISO_DATE),
         ("credit_limit", "decimal", "credit_limit"), ("is_active", "flag", "is_active")]),
    _extract(
        "SOURCE_A", "Suppliers", "source_a/suppliers.csv",
        "supplier_id company_name contact_name email phone address city country tax_id payment_terms is_active",
        [("supplier_code", "id"), ("company_name", "required", "company_name"),
         ("contact_name", "optional", "contact_name"), ("email", "email", "email"), ("phone", "optional", "phone"),
         ("address", "optional", "address"), ("city", "optional", "city"), ("country", "optional", "country"),
         ("tax_id", "optional", "tax_id"), ("payment_terms", "optional", "payment_terms"),
         ("is_active", "flag", "is_active")]),
    _extract(
        "SOURCE_A", "Products", "source_a/products.csv",
        "product_id product_name category unit_price supplier_id sku description is_active created_date",
        [("product_code", "id"), ("product_name", "required", "product_name"), ("category", "optional", "category"),
         ("unit_price", "decimal", "unit_price"), ("supplier_code", "optional", "supplier_id"),
         ("sku", "optional", "sku"), ("description", "optional", "description"), ("uom", "constant", None, "UNIDAD"),
         ("is_active", "flag", "is_active"), ("created_date", "optional_date", "created_date", ISO_DATE)]),
    _extract(
        "SOURCE_A", "Invoices", "source_a/invoices.csv",
        "invoice_id customer_id invoice_date due_date total_amount tax_amount status payment_method",
        [("invoice_number", "id"), ("customer_code", "key", "customer_id"),
         ("invoice_date", "date", "invoice_date", ISO_DATE), ("due_date", "optional_date", "due_date", ISO_DATE),
         ("total_amount", "decimal", "total_amount"), ("tax_amount", "decimal", "tax_amount"),
         ("subtotal", "difference", "total_amount", "tax_amount"), ("status", "default", "status", "PENDING"),
         ("payment_method", "optional", "payment_method")]),
    _extract(
        "SOURCE_A", "InvoiceLines", "source_a/invoice_lines.csv",
        "line_id invoice_id product_id quantity unit_price discount_pct line_total",
        [("invoice_code", "key", "invoice_id"), ("product_code", "code", "product_id"),
         ("quantity", "decimal", "quantity"), ("unit_price", "decimal", "unit_price"),
         ("discount_pct", "decimal", "discount_pct"), ("line_total", "decimal", "line_total")]),
    _extract(
        "SOURCE_A", "Payments", "source_a/payments.csv",
        "payment_id invoice_id payment_date amount payment_method reference_number status",
        [("payment_number", "id"), ("invoice_code", "key", "invoice_id"),
         ("payment_date", "date", "payment_date", ISO_DATE), ("amount", "decimal", "amount"), ("amount_text", "decimal_text", "amount"),
         ("payment_method", "code", "payment_method"), ("reference_number", "code", "reference_number"),
         ("status", "default", "status", "COMPLETED")]),
    _extract(
        "SOURCE_B", "Customers", "source_b/clientes.csv",
        "IdCliente NombreCompleto CorreoElectronico Telefono Direccion Ciudad Pais FechaRegistro RFC Activo "
        "LimiteCredito TipoCliente",
        [("customer_code", "id"), ("full_name", "required", "NombreCompleto"),
         ("first_name", "first_name", "NombreCompleto"), ("last_name", "last_name", "NombreCompleto"),
         ("email", "email", "CorreoElectronico"), ("phone", "optional", "Telefono"),
         ("address", "optional", "Direccion"), ("city", "optional", "Ciudad"), ("country", "optional", "Pais"),
         ("tax_id", "optional", "RFC"), ("registration_date", "date", "FechaRegistro", DAY_FIRST_DATE),
         ("credit_limit", "decimal", "LimiteCredito"), ("is_active", "flag", "Activo")]),
    _extract(
        "SOURCE_B", "Suppliers", "source_b/proveedores.csv",
        "IdProveedor RazonSocial NombreContacto Correo Telefono DireccionCompleta Ciudad Pais NIT TerminosPago Activo "
        "Categoria",
        [("supplier_code", "id"), ("company_name", "required", "RazonSocial"),
         ("contact_name", "optional", "NombreContacto"), ("email", "email", "Correo"),
         ("phone", "optional", "Telefono"), ("address", "optional", "DireccionCompleta"),
         ("city", "optional", "Ciudad"), ("country", "optional", "Pais"), ("tax_id", "optional", "NIT"),
         ("payment_terms", "optional", "TerminosPago"), ("is_active", "flag", "Activo")]),
    _extract(
        "SOURCE_B", "Products", "source_b/productos.csv",
        "IdProducto NombreProducto Categoria PrecioUnitario IdProveedor CodigoBarras Descripcion Activo FechaCreacion "
        "UnidadMedida",
        [("product_code", "id"), ("product_name", "required", "NombreProducto"),
         ("category", "optional", "Categoria"), ("unit_price", "decimal", "PrecioUnitario"),
         ("supplier_code", "optional", "IdProveedor"), ("sku", "optional", "CodigoBarras"),
         ("description", "optional", "Descripcion"), ("uom", "optional", "UnidadMedida"),
         ("is_active", "flag", "Activo"), ("created_date", "optional_date", "FechaCreacion", DAY_FIRST_DATE)]),
    _extract(
        "SOURCE_B", "Invoices", "source_b/facturas.csv",
        "IdFactura IdCliente FechaFactura FechaVencimiento Subtotal IVA Total Estado MetodoPago Sucursal",
        [("invoice_number", "id"), ("customer_code", "key", "IdCliente"),
         ("invoice_date", "date", "FechaFactura", DAY_FIRST_DATE),
         ("due_date", "optional_date", "FechaVencimiento", DAY_FIRST_DATE),
         ("total_amount", "decimal", "Total"), ("tax_amount", "decimal", "IVA"), ("subtotal", "decimal", "Subtotal"),
         ("status", "default", "Estado", "PENDING"), ("payment_method", "optional", "MetodoPago")]),
    _extract(
        "SOURCE_B", "InvoiceLines", "source_b/factura_lineas.csv",
        "IdLinea IdFactura IdProducto Cantidad PrecioUnitario Descuento TotalLinea",
        [("invoice_code", "key", "IdFactura"), ("product_code", "code", "IdProducto"),
         ("quantity", "decimal", "Cantidad"), ("unit_price", "decimal", "PrecioUnitario"),
         ("discount_pct", "decimal", "Descuento"), ("line_total", "decimal", "TotalLinea")]),
    _extract(
        "SOURCE_B", "Payments", "source_b/pagos.csv",
        "IdPago IdFactura FechaPago Monto MetodoPago Referencia Estado Banco Comision",
        [("payment_number", "id"), ("invoice_code", "key", "IdFactura"),
         ("payment_date", "date", "FechaPago", DAY_FIRST_DATE), ("amount", "decimal", "Monto"), ("amount_text", "decimal_text", "Monto"),
         ("payment_method", "code", "MetodoPago"), ("reference_number", "code", "Referencia"),
         ("status", "default", "Estado", "COMPLETED")]),
    _extract(
        "SOURCE_C", "Products", "source_c/products_catalog.csv",
        "product_code name category price supplier_code description active uom",
        [("product_code", "id"), ("product_name", "required", "name"), ("category", "optional", "category"),
         ("unit_price", "decimal", "price"), ("supplier_code", "optional", "supplier_code"), ("sku", "null"),
         ("description", "optional", "description"), ("uom", "optional", "uom"), ("is_active", "flag", "active"),
         ("created_date", "null")]),
)


def by_table(table: str) -> list[Extract]:
    return [e for e in EXTRACTS if e.table == table]


def by_source(source_system: str) -> list[Extract]:
    return [e for e in EXTRACTS if e.source_system == source_system]


def named(name: str) -> Extract:
    return next(e for e in EXTRACTS if e.name == name)
