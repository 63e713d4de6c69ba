"""DuckDB SQL for what the consolidation must produce from the raw extracts."""

from __future__ import annotations

from ledgerloom.sources.extracts import Extract, Field, by_table
from workload.raw_extracts import raw_sql

SPACES = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
EVENT = "STRUCT(action VARCHAR, reason VARCHAR, field VARCHAR, original_value VARCHAR, new_value VARCHAR)"
DATE_FORMATS = {"yyyy-MM-dd": "%Y-%m-%d", "d/M/yyyy": "%d/%m/%Y"}
MONEY = "DECIMAL(37,12)"


def clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '" + SPACES + "', ' ', 'g'))"


def event(action: str, reason: str, field: str, original: str = "''", new: str = "''") -> str:
    return (f"CAST({{'action': '{action}', 'reason': '{reason}', 'field': '{field}', "
            f"'original_value': coalesce({original}, ''), 'new_value': coalesce({new}, '')}} AS {EVENT})")


def digits(text: str, source: str) -> str:
    if source == "SOURCE_B":
        text = (f"(CASE WHEN contains({text}, ',') THEN replace(replace({text}, '.', ''), ',', '.') "
                f"ELSE {text} END)")
    return f"trim(replace(replace({text}, '$', ''), ',', ''))"


def amount(column: str, source: str) -> str:
    return f"coalesce(TRY_CAST({digits(clean(column), source)} AS {MONEY}), 0)"


def required(column: str) -> str:
    return f"CASE WHEN {clean(column)} = '' THEN 'NO DISPONIBLE' ELSE {clean(column)} END"


def rule_sql(field: Field, extract: Extract) -> tuple[str, str | None]:
    """Value and event of one field."""
    raw = f'"{field.source}"' if field.source else ""
    text, target, source = clean(raw), field.target, extract.source_system
    ident = f'"{extract.id_column}"'
    match field.rule:
        case "id":
            return clean(ident), None
        case "required":
            return required(raw), (
                f"CASE WHEN {text} = '' THEN {event('default_applied', 'Texto obligatorio vacio', target, raw, repr('NO DISPONIBLE'))} "
                f"WHEN {text} <> {raw} THEN {event('cleaned', 'Whitespace normalizado', target, raw, text)} END")
        case "optional":
            return f"nullif({text}, '')", (
                f"CASE WHEN {text} <> {raw} AND {raw} <> '' THEN "
                f"{event('cleaned', 'Whitespace normalizado', target, raw, text)} END")
        case "email":
            default = "'no_disponible@placeholder.com'"
            return f"CASE WHEN {text} = '' THEN {default} ELSE lower({text}) END", (
                f"CASE WHEN {text} = '' THEN {event('default_applied', 'Email vacio', target, raw, default)} END")
        case "date" | "optional_date":
            parsed = f"CAST(TRY_STRPTIME({text}, '{DATE_FORMATS[field.extra]}') AS DATE)"
            if field.rule == "optional_date":
                lost = event("cleaned", "Fecha opcional invalida convertida a NULL", target, raw)
                return parsed, f"CASE WHEN {text} <> '' AND {parsed} IS NULL THEN {lost} END"
            default = "'1900-01-01'"
            return f"coalesce({parsed}, DATE {default})", (
                f"CASE WHEN {text} = '' THEN {event('default_applied', 'Fecha vacia', target, raw, default)} "
                f"WHEN {parsed} IS NULL THEN {event('default_applied', 'Fecha invalida', target, raw, default)} END")
        case "decimal":
            number = digits(text, source)
            bad = event("default_applied", "Decimal invalido", target, raw, "'0'")
            large = event("default_applied", "Decimal fuera de rango", target, raw, "'0'")
            return f"CAST({amount(raw, source)} AS {MONEY})", (
                f"CASE WHEN TRY_CAST({number} AS {MONEY}) IS NULL AND regexp_matches({number}, '^[+-]?[0-9]+([.][0-9]*)?$') THEN {large} "
                f"WHEN {number} <> '' AND TRY_CAST({number} AS {MONEY}) IS NULL THEN {bad} END")
        case "decimal_text":
            number = digits(text, source)
            return f"CASE WHEN TRY_CAST({number} AS {MONEY}) IS NULL THEN '0' ELSE {number} END", None
        case "flag":
            return f"lower({text}) IN ('1', 'true', 't', 'yes', 'y', 'si', 'activo')", None
        case "key":
            return text, None
        case "code":
            return f"nullif({text}, '')", None
        case "default":
            return f"CASE WHEN {text} = '' THEN '{field.extra}' ELSE {text} END", None
        case "constant":
            return f"'{field.extra}'", None
        case "null":
            return "CAST(NULL AS DATE)" if target == "created_date" else "CAST(NULL AS VARCHAR)", None
        case "first_name":
            return f"split_part({required(raw)}, ' ', 1)", None
        case "last_name":
            name = required(raw)
            return (f"CASE WHEN strpos({name}, ' ') = 0 THEN 'NO DISPONIBLE' "
                    f"ELSE substr({name}, strpos({name}, ' ') + 1) END"), None
        case "difference":
            other = f'"{field.extra}"'
            return f"CAST({amount(raw, source)} - {amount(other, source)} AS {MONEY})", None
    raise ValueError(field.rule)


def staged_sql(extract: Extract) -> str:
    done = {f.target: rule_sql(f, extract) for f in extract.fields}
    ident = f'"{extract.id_column}"'
    blank = f"{clean(ident)} = ''"
    events = ", ".join(e for _, e in done.values() if e) or f"CAST(NULL AS {EVENT})"
    values = ", ".join(f"{v} AS {t}" for t, (v, _) in sorted(done.items()))
    missing = event("excluded", "Registro sin ID de origen", extract.id_column)
    return (f"SELECT '{extract.table}' AS \"table\", '{extract.source_system}' AS source_system, "
            f"CASE WHEN {blank} THEN {ident} ELSE {clean(ident)} END AS source_id, {values}, _seq, "
            f"CASE WHEN {blank} THEN 'Registro sin ID de origen' END AS reject, "
            f"CASE WHEN {blank} THEN [{missing}] ELSE list_filter([{events}], lambda e: e IS NOT NULL) END AS events "
            f"FROM ({raw_sql(extract.name)})")


def table_sql(table: str) -> str:
    return " UNION ALL BY NAME ".join(f"({staged_sql(e)})" for e in by_table(table))


def child_sql(rows: str, parents: str, code: str, reason: str) -> str:
    orphan = (f"reject IS NULL AND NOT EXISTS (SELECT 1 FROM {parents} p WHERE p.reject IS NULL "
              f"AND p.source_system = r.source_system AND p.source_id = r.{code})")
    gone = event("excluded", reason, code, f"r.{code}")
    return (f"SELECT * REPLACE (CASE WHEN orphan THEN '{reason}' ELSE reject END AS reject, "
            f"CASE WHEN orphan THEN [{gone}] ELSE events END AS events) "
            f"FROM (SELECT *, ({orphan}) AS orphan FROM {rows} r) r")


PAYMENTS = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_system, invoice_code, payment_date, amount,
                                            coalesce(payment_method, ''), coalesce(reference_number, '')
                               ORDER BY _seq) AS occurrence
  FROM held WHERE reject IS NULL),
ranked AS (
  SELECT n.*, c.cap, row_number() OVER (PARTITION BY n.source_system, n.invoice_code ORDER BY n._seq) AS place
  FROM numbered n JOIN (SELECT source_system, source_id, arg_max(total_amount, _seq) AS cap FROM accepted_invoices
                        GROUP BY ALL) c ON n.source_system = c.source_system AND n.invoice_code = c.source_id
  WHERE occurrence = 1),
walk AS (
  SELECT source_system, invoice_code, _seq, place, amount <= cap AS fits,
         CASE WHEN amount <= cap THEN amount ELSE 0 END AS paid
  FROM ranked WHERE place = 1
  UNION ALL
  SELECT r.source_system, r.invoice_code, r._seq, r.place, w.paid + r.amount <= r.cap,
         CASE WHEN w.paid + r.amount <= r.cap THEN w.paid + r.amount ELSE w.paid END
  FROM walk w JOIN ranked r ON r.source_system = w.source_system AND r.invoice_code = w.invoice_code
                           AND r.place = w.place + 1),
"""


def consolidation(wanted: str) -> str:
    """All staged tables as common table expressions, then ``wanted``."""
    printed = ("concat_ws('|', source_system, invoice_code, CAST(payment_date AS VARCHAR), amount_text, "
               "coalesce(payment_method, ''), coalesce(reference_number, ''))")
    repeat = event("excluded", "Pago duplicado exacto", "dedupe_key", printed)
    over = event("excluded", "Pago excede el total acumulado de la factura", "amount", "amount_text")
    return f"""
WITH RECURSIVE
customers_ AS MATERIALIZED ({table_sql("Customers")}),
suppliers_ AS MATERIALIZED ({table_sql("Suppliers")}),
products_ AS MATERIALIZED ({table_sql("Products")}),
invoices_raw AS MATERIALIZED ({table_sql("Invoices")}),
invoices_ AS MATERIALIZED ({child_sql("invoices_raw", "customers_", "customer_code", "Factura con cliente inexistente")}),
accepted_invoices AS MATERIALIZED (SELECT * FROM invoices_ WHERE reject IS NULL),
lines_raw AS MATERIALIZED ({table_sql("InvoiceLines")}),
lines_ AS MATERIALIZED ({child_sql("lines_raw", "invoices_", "invoice_code", "Linea con factura inexistente")}),
payments_raw AS MATERIALIZED ({table_sql("Payments")}),
held AS MATERIALIZED ({child_sql("payments_raw", "invoices_", "invoice_code", "Pago con factura inexistente")}),
{PAYMENTS}
payments_ AS MATERIALIZED (
  SELECT * FROM held WHERE reject IS NOT NULL
  UNION ALL BY NAME
  SELECT * REPLACE ('Pago duplicado exacto' AS reject, list_append(events, {repeat}) AS events)
  FROM numbered WHERE occurrence > 1
  UNION ALL BY NAME
  SELECT r.* REPLACE (CASE WHEN w.fits THEN NULL ELSE 'Pago excede el total acumulado de la factura' END AS reject,
                      CASE WHEN w.fits THEN events ELSE list_append(events, {over}) END AS events)
  FROM ranked r JOIN walk w USING (_seq))
{wanted}"""


ALL_EVENTS = "(" + " UNION ALL ".join(
    f'SELECT "table", source_system, source_id, unnest(events) AS e FROM {t}'
    for t in ("customers_", "suppliers_", "products_", "invoices_", "lines_", "payments_")) + ")"
