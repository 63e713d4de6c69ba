"""The exploratory profile of the extracts, as tables instead of printed cells."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import clean_text, profile_decimal
from ledgerloom.operators import keysets as k
from ledgerloom.operators import profiling as p
from ledgerloom.operators.joins import orphans
from ledgerloom.session import cut
from ledgerloom.sources.extracts import EXTRACTS, named

Extracts = dict[str, DataFrame]

# Date columns the sweep looks at; creation dates of SOURCE_B are not among them.
SWEPT_DATES = {
    "source_a/customers": ["registration_date"],
    "source_a/products": ["created_date"],
    "source_a/invoices": ["invoice_date", "due_date"],
    "source_a/payments": ["payment_date"],
    "source_b/clientes": ["FechaRegistro"],
    "source_b/facturas": ["FechaFactura", "FechaVencimiento"],
    "source_b/pagos": ["FechaPago"],
}

# (child, foreign key, parent, key)
RELATIONS = [
    ("source_a/products", "supplier_id", "source_a/suppliers", "supplier_id"),
    ("source_a/invoices", "customer_id", "source_a/customers", "customer_id"),
    ("source_a/invoice_lines", "invoice_id", "source_a/invoices", "invoice_id"),
    ("source_a/invoice_lines", "product_id", "source_a/products", "product_id"),
    ("source_a/payments", "invoice_id", "source_a/invoices", "invoice_id"),
    ("source_b/productos", "IdProveedor", "source_b/proveedores", "IdProveedor"),
    ("source_b/facturas", "IdCliente", "source_b/clientes", "IdCliente"),
    ("source_b/factura_lineas", "IdFactura", "source_b/facturas", "IdFactura"),
    ("source_b/factura_lineas", "IdProducto", "source_b/productos", "IdProducto"),
    ("source_b/pagos", "IdFactura", "source_b/facturas", "IdFactura"),
]

PAYMENT_KEYS = {
    "source_a/payments": ["invoice_id", "payment_date", "amount", "payment_method", "reference_number"],
    "source_b/pagos": ["IdFactura", "FechaPago", "Monto", "MetodoPago", "Referencia"],
}


def parsed_once(raw: Extracts) -> Extracts:
    """Columnar copies of the extracts. The checks go over them many times, and then parse no
    text again and read only the columns they need."""
    return {e.name: cut(raw[e.name]) for e in EXTRACTS}


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _labelled(df: DataFrame, name: str) -> DataFrame:
    extract = named(name)
    return df.select(F.lit(extract.source_system).alias("source"), F.lit(name.split("/")[1]).alias("table"), "*")


def table_profiles(raw: Extracts) -> DataFrame:
    """Per column with missing values: how many, and their share in percent."""
    return union([_labelled(p.null_profile(raw[e.name].select(*e.columns)), e.name) for e in EXTRACTS])


def row_profiles(raw: Extracts) -> DataFrame:
    """Rows, columns, rows that repeat an earlier one, and repeats of the id."""
    parts = []
    for e in EXTRACTS:
        df = raw[e.name].select(*e.columns)
        unknown = F.lit(None).cast("bigint")
        whole = p.repeated_rows(df).withColumn("repeated_ids", unknown)
        ids = p.repeated_rows(df, [e.id_column]).select(
            "row_count", unknown.alias("repeated_rows"), F.col("repeated_rows").alias("repeated_ids"))
        # One row each, put side by side.
        both = whole.unionByName(ids).agg(
            F.lit(len(e.columns)).alias("column_count"),
            *[F.max(c).alias(c) for c in ("row_count", "repeated_rows", "repeated_ids")])
        parts.append(_labelled(both, e.name))
    return union(parts)


def whitespace(raw: Extracts) -> DataFrame:
    return union([_labelled(p.whitespace_profile(raw[e.name].select(*e.columns)), e.name) for e in EXTRACTS])


def missing_ids(raw: Extracts) -> DataFrame:
    return union([
        _labelled(p.missing_id_count(raw[e.name], e.id_column), e.name).withColumn("column", F.lit(e.id_column))
        for e in EXTRACTS])


def invalid_dates(raw: Extracts) -> DataFrame:
    parts = []
    for name, columns in SWEPT_DATES.items():
        formats = {f.source: f.extra for f in named(name).dates()}
        parts.append(_labelled(p.invalid_dates_count(raw[name], {c: formats[c] for c in columns}), name))
    return union(parts)


def orphan_rows(raw: Extracts, child: str, key: str, parent: str, parent_key: str) -> DataFrame:
    return orphans(raw[child].withColumn(key, F.col(key)), raw[parent].select(F.col(parent_key).alias("_parent")),
                   {key: "_parent"})


def orphan_counts(raw: Extracts) -> DataFrame:
    """Rows without a parent for every relation. Each extract is scanned once, for its own keys and for those it refers to."""
    domains = {(parent, key): [r for r in RELATIONS if r[2:] == (parent, key)] for parent, key in dict.fromkeys(r[2:] for r in RELATIONS)}
    sides = 1 + max(map(len, domains.values()))
    tags: dict[str, list[k.Tag]] = {}
    for (parent, parent_key), relations in domains.items():
        tags.setdefault(parent, []).append(k.Tag(parent, F.col(parent_key), keep=F.col(parent_key).isNotNull()))
        for side, (child, key, _, _) in enumerate(relations, 1):
            tags.setdefault(child, []).append(k.Tag(parent, F.col(key), side))
    found = k.orphan_totals(k.side_counts(union([k.tagged(raw[name], own) for name, own in tags.items()]), sides), sides)
    names = [F.struct(F.lit(parent).alias("domain"), F.lit(side).alias("side"), F.lit(named(child).source_system).alias("source"),
                      F.lit(child.split("/")[1]).alias("table"), F.lit(key).alias("column"))
             for (parent, _), relations in domains.items() for side, (child, key, _, _) in enumerate(relations, 1)]
    # Ten relations, also those whose tables are empty.
    labels = found.sparkSession.range(1).select(F.explode(F.array(*names)).alias("l")).select("l.*")
    return labels.join(found, ["domain", "side"], "left").select(
        "source", "table", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("affected_rows"), "column")


def column_types(raw: Extracts) -> DataFrame:
    """The type that all values of a column have together."""
    return union([_labelled(p.column_types(raw[e.name].select(*e.columns)), e.name) for e in EXTRACTS])


def payments_a(raw: Extracts) -> tuple[DataFrame, DataFrame]:
    """Payments and invoices of SOURCE_A with numeric amounts."""
    payments = raw["source_a/payments"].withColumn("paid", F.col("amount").try_cast("decimal(37,12)"))
    return payments, raw["source_a/invoices"].withColumn("total", F.col("total_amount").try_cast("decimal(37,12)"))


def payments_b(raw: Extracts) -> tuple[DataFrame, DataFrame]:
    """The same for SOURCE_B, whose payments write decimals with a comma and invoices with a point."""
    payments = raw["source_b/pagos"].withColumn("paid", profile_decimal(F.col("Monto")))
    return payments, raw["source_b/facturas"].withColumn("total", F.col("Total").try_cast("decimal(37,12)"))


def overpaid(raw: Extracts, source: str) -> DataFrame:
    if source == "SOURCE_A":
        return p.overpaid(*payments_a(raw), "invoice_id", "paid", "total")
    return p.overpaid(*payments_b(raw), "IdFactura", "paid", "total")


def customer_overlap(raw: Extracts) -> DataFrame:
    return p.shared_codes(raw["source_a/customers"], "tax_id", raw["source_b/clientes"], "RFC")


def supplier_overlap(raw: Extracts) -> DataFrame:
    return p.shared_codes(raw["source_a/suppliers"], "tax_id", raw["source_b/proveedores"], "NIT")


def product_overlap(raw: Extracts) -> DataFrame:
    return p.code_overlap({"SOURCE_A": (raw["source_a/products"], "sku"),
                           "SOURCE_B": (raw["source_b/productos"], "CodigoBarras"),
                           "SOURCE_C": (raw["source_c/products_catalog"], "product_code")})


@dataclass(frozen=True)
class RowCheck:
    """A finding about single values of one extract; each affected value counts."""

    extract: str
    issue: str
    tolerance: str
    action: str
    columns: tuple[str, ...]
    kind: str

    def failing(self, df: DataFrame) -> Column:
        """How many values of a row fail; a null one does not."""
        tests = []
        for column in self.columns:
            value = F.col(column)
            if self.kind == "missing":
                tests.append(p.missing(df, column))
            elif self.kind == "spaces":
                tests.append(p.stripped(column) != value)
            elif self.kind == "uneven":
                tests.append((p.stripped(column) != value) | F.contains(value, F.lit("  ")))
            elif self.kind == "comma":
                tests.append(F.contains(value, F.lit(",")))
            else:
                tests.append(F.contains(value, F.lit("$")))
        return reduce(Column.__add__, [F.coalesce(t, F.lit(False)).cast("int") for t in tests])


# What the report checks, with its wording.
A_CUSTOMER_TEXT = ("customer_id", "first_name", "last_name", "email", "phone", "address", "city", "country",
                   "registration_date", "tax_id", "is_active")
ROW_CHECKS = (
    RowCheck("source_a/customers", "missing email", "ALTA", "fill with placeholder", ("email",), "missing"),
    RowCheck("source_a/customers", "extra spaces", "MEDIA", "trim", A_CUSTOMER_TEXT, "spaces"),
    RowCheck("source_a/suppliers", "missing email or contact", "ALTA", "fill with placeholder",
             ("email", "contact_name"), "missing"),
    RowCheck("source_a/suppliers", "extra spaces in company", "MEDIA", "trim", ("company_name",), "spaces"),
    RowCheck("source_b/clientes", "missing email", "ALTA", "fill with placeholder", ("CorreoElectronico",), "missing"),
    RowCheck("source_b/clientes", "uneven spaces in name", "MEDIA", "collapse spaces", ("NombreCompleto",), "uneven"),
    RowCheck("source_b/proveedores", "missing email", "ALTA", "fill with placeholder", ("Correo",), "missing"),
    RowCheck("source_b/proveedores", "extra spaces in company", "MEDIA", "trim", ("RazonSocial",), "spaces"),
    RowCheck("source_b/productos", "price with comma", "MEDIA", "parse as decimal", ("PrecioUnitario",), "comma"),
    RowCheck("source_b/productos", "missing supplier", "ALTA", "allow NULL and report", ("IdProveedor",), "missing"),
    RowCheck("source_b/pagos", "amount with comma", "MEDIA", "parse as decimal", ("Monto",), "comma"),
    RowCheck("source_b/pagos", "missing bank", "MEDIA", "expected for cash", ("Banco",), "missing"),
    RowCheck("source_c/products_catalog", "price with currency sign", "MEDIA", "strip the sign", ("price",), "sign"),
    RowCheck("source_c/products_catalog", "missing supplier", "ALTA", "allow NULL and report", ("supplier_code",),
             "missing"),
    RowCheck("source_c/products_catalog", "extra spaces in name", "MEDIA", "trim", ("name",), "spaces"),
)


# The labels of the findings report.
UNKNOWN_CUSTOMER = ("unknown customer", "CERO", "exclude the invoice and its dependents")
BEYOND_TOTAL = ("payments exceed the invoice total", "CERO", "exclude the payments beyond it")
SEVERAL_PAYMENTS = ("invoices with several payments", "CRITERIO", "accept within the invoice total")
REPEATED_PAYMENTS = ("repeated payments", "CRITERIO", "keep the first of equal business keys")
NO_ID = ("missing source id", "CERO", "exclude the row")
NO_DATE = ("missing or invalid date", "ALTA", "use 1900-01-01")
SHARED_TAX_ID = ("tax id in both sources", "CRITERIO", "keep both records")
NO_COMMON_CODE = ("no common product code", "CRITERIO", "keep every product with its source")

PRODUCT_CODES = {"source_a/products": "sku", "source_b/productos": "CodigoBarras", "source_c/products_catalog": "product_code"}
FINDING = ["source", "table", "issue", "tolerance", "action"]


INVOICES = {"source_a/payments": "source_a/invoices", "source_b/pagos": "source_b/facturas"}
TAX_IDS = {"source_a/customers": ("customers", "tax_id"), "source_b/clientes": ("customers", "RFC"),
           "source_a/suppliers": ("suppliers", "tax_id"), "source_b/proveedores": ("suppliers", "NIT")}
# What tags of the findings carry besides their key: the rest of a payment's business key, amounts, and how many values fail.
CARRIED = {"rest": "string", "paid": k.DECIMAL, "total": k.DECIMAL, "failing": "int"}


def _check_labels(name: str) -> list[tuple[str, str, tuple[str, str, str]]]:
    """Source, table and wording of what single rows of an extract tell."""
    own = (named(name).source_system, name.split("/")[1])
    found = [(*own, (c.issue, c.tolerance, c.action)) for c in ROW_CHECKS if c.extract == name]
    found.append(("GLOBAL", "all_sources", NO_ID))
    return [*found, ("GLOBAL", "date_fields", NO_DATE)] if name in SWEPT_DATES else found


def _row_checks(df: DataFrame, name: str) -> list[Column]:
    """How many values of a row fail each of these checks."""
    found = [c.failing(df) for c in ROW_CHECKS if c.extract == name]
    found.append((clean_text(F.col(named(name).id_column)) == "").cast("int"))
    if name in SWEPT_DATES:
        patterns = {f.source: f.extra for f in named(name).dates()}
        bad = [F.try_to_date(F.col(c), patterns[c]).isNull().cast("int") for c in SWEPT_DATES[name]]
        found.append(reduce(Column.__add__, bad))
    return found


def _finding_tags(df: DataFrame, name: str) -> list[k.Tag]:
    """Everything the findings need of a row: its checks, its own keys, and those it refers to."""
    none = F.lit(None)
    tags = [k.Tag(f"check {i} {name}", none, keep=failing > 0, more={"failing": failing}) for i, failing in enumerate(_row_checks(df, name))]
    for child, key, parent, parent_key in RELATIONS:
        if child in INVOICES.values() and name in (child, parent):
            key = F.col(key if name == child else parent_key)
            tags.append(k.Tag(f"orphans {child}", key, int(name == child), key.isNotNull() | F.lit(name == child)))
    for paying, invoices in INVOICES.items():
        if name == paying:
            amount = F.col("amount").try_cast(k.DECIMAL) if name == "source_a/payments" else profile_decimal(F.col("Monto"))
            first, *others = PAYMENT_KEYS[name]
            rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
            tags.append(k.Tag(f"paid {paying}", F.col(first), 1, more={"rest": rest, "paid": amount}))
        if name == invoices:
            total = F.col("total_amount" if name == "source_a/invoices" else "Total").try_cast(k.DECIMAL)
            tags.append(k.Tag(f"paid {paying}", F.col(named(name).id_column), 0, ~p.missing(df, named(name).id_column), {"total": total}))
    for kind, (table, column) in (("shared", TAX_IDS.get(name, ("", ""))), ("codes", (name, PRODUCT_CODES.get(name, "")))):
        if column:
            side = int(kind == "shared" and named(name).source_system != "SOURCE_A")
            tags.append(k.Tag(f"{kind} {table}", p.stripped(column), side, ~p.missing(df, column)))
    return tags


def _domain_totals(tags: DataFrame) -> DataFrame:
    """One row per domain: each measure that a finding can be. Payments are added up by business key first."""
    sums = [F.sum("paid").alias("paid"), F.max("total").alias("total"), F.sum("failing").alias("failing")]
    same = tags.groupBy("domain", "key", "rest").agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"), *sums)
    again = F.sum(F.when(F.col("n1") > 1, F.col("n1"))).alias("again")
    keys = same.groupBy("domain", "key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), again, *sums)
    known = ~(F.col("key").isNull() | F.col("key").isin(p.BLANK_TOKENS))
    excess = F.round(F.col("paid") - F.col("total"), 2) > F.lit(p.TOLERANCE).cast("decimal(3,2)")
    return keys.groupBy("domain").agg(
        F.sum("again").alias("again"), F.count_if(known & (F.col("n1") > 1)).alias("several"), F.count_if(known & excess).alias("beyond"),
        F.sum(F.when(F.col("key").isNull() | (F.col("n0") == 0), F.col("n1"))).alias("orphans"),
        k.shared_keys(keys).alias("shared"), F.count_if(F.col("n0") > 0).alias("keys"), F.sum("failing").alias("failing"))


def _labels() -> list[tuple[str, str, str, str, tuple[str, str, str]]]:
    """Domain and measure of every finding, and its source, table and wording."""
    found = [(f"check {i} {e.name}", "failing", *label) for e in EXTRACTS for i, label in enumerate(_check_labels(e.name))]
    for paying, invoices in INVOICES.items():
        own = (named(paying).source_system, paying.split("/")[1])
        found += [(f"paid {paying}", measure, *own, label) for measure, label in
                  (("again", REPEATED_PAYMENTS), ("several", SEVERAL_PAYMENTS), ("beyond", BEYOND_TOTAL))]
        found.append((f"orphans {invoices}", "orphans", named(invoices).source_system, invoices.split("/")[1], UNKNOWN_CUSTOMER))
    found += [(f"shared {table}", "shared", "CROSS", table, SHARED_TAX_ID) for table in ("customers", "suppliers")]
    return found + [(f"codes {name}", "keys", "CROSS", "products", NO_COMMON_CODE) for name in PRODUCT_CODES]


def findings(raw: Extracts) -> DataFrame:
    """The consolidated list of findings with the number of values, rows or keys each one affects.

    Every extract is scanned once: its rows emit their checks and all keys that any finding needs, and three aggregates, by
    business key, by key and by domain, turn them into one row of measures for each domain."""
    totals = _domain_totals(union([k.tagged(raw[e.name], _finding_tags(raw[e.name], e.name), CARRIED) for e in EXTRACTS]))
    measures = [c for c in totals.columns if c != "domain"]
    values = F.create_map(*[x for m in measures for x in (F.lit(m), F.col(m).cast("bigint"))])
    labels = [F.struct(*[F.lit(x).alias(n) for n, x in zip(["domain", "measure", *FINDING], (domain, measure, source, table, *label))])
              for domain, measure, source, table, label in _labels()]
    wanted = totals.sparkSession.range(1).select(F.explode(F.array(*labels)).alias("l")).select("l.*")
    rows = wanted.join(totals.select("domain", values.alias("values")), "domain", "left")
    rows = rows.groupBy(*FINDING).agg(F.coalesce(F.sum(F.col("values")[F.col("measure")]), F.lit(0)).alias("affected_rows"))
    return rows.select("source", "table", "issue", "affected_rows", "tolerance", "action")


def profile(raw: Extracts) -> dict[str, DataFrame]:
    """Every profiling table of the extracts."""
    raw = parsed_once(raw)
    return {
        "null_columns": table_profiles(raw),
        "column_types": column_types(raw),
        "row_profiles": row_profiles(raw),
        "whitespace": whitespace(raw),
        "missing_ids": missing_ids(raw),
        "invalid_dates": invalid_dates(raw),
        "orphans": orphan_counts(raw),
        "overpaid_a": overpaid(raw, "SOURCE_A"),
        "overpaid_b": overpaid(raw, "SOURCE_B"),
        "amount_mismatch_b": p.unequal_sums(
            raw["source_b/facturas"].withColumns({c: F.col(c).try_cast("decimal(37,12)")
                                                  for c in ("Subtotal", "IVA", "Total")}),
            ["Subtotal", "IVA"], "Total"),
        "missing_bank_methods": p.frequency_where(
            raw["source_b/pagos"], p.missing(raw["source_b/pagos"], "Banco"), "MetodoPago"),
        "customer_overlap": customer_overlap(raw),
        "supplier_overlap": supplier_overlap(raw),
        "product_overlap": product_overlap(raw),
        "findings": findings(raw),
    }
