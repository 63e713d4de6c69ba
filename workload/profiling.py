"""Profiling of the given tables and of the extracts derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.operators import profiling as p
from ledgerloom.operators.payments import accept_within_cap, mark_first
from ledgerloom.plans import profile as job
from ledgerloom.sources import tables
from ledgerloom.session import cut, spread
from ledgerloom.sources.extracts import EXTRACTS, named
from workload import expected as sql
from workload.raw_extracts import PAYMENT_ROWS, PAYMENT_SEQ, RawExtracts, raw_sql
from workload.registry import query


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^{sql.SPACES}|{sql.SPACES}$', '', 'g')"


def blank(column: str) -> str:
    return f"{column} IN ({', '.join(repr(t) for t in p.BLANK_TOKENS)})"


# Events with some values blanked out.
EVENTS = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 8 = 0 THEN NULL ELSE event_type END AS event_type, value
FROM {events}"""


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(EVENTS, events=tables.table(spark, folder, "events"))


EVENTS_SQL = f"({EVENTS.format(events='events')})"


@query("profile_nulls", f"""
SELECT column_name AS "column", null_count, round(null_count / row_count * 100, 1) AS null_percent
FROM (SELECT count(*) AS row_count, count(*) FILTER (user_id IS NULL) AS u,
             count(*) FILTER (event_type IS NULL OR event_type = '') AS t FROM {EVENTS_SQL}) c,
     LATERAL (SELECT unnest(['user_id', 'event_type']) AS column_name, unnest([u, t]) AS null_count)""")
def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return p.null_profile(_events(spark, folder))


@query("rows_with_missing", f"""
SELECT * FROM {EVENTS_SQL} WHERE event_id IS NULL OR user_id IS NULL OR event_type IS NULL OR event_type = '' OR value IS NULL""")
def rows_with_missing(spark: SparkSession, folder: str) -> DataFrame:
    return p.rows_with_missing(_events(spark, folder))


@query("missing_value_rows", f"SELECT event_id, user_id, event_type FROM {EVENTS_SQL} WHERE user_id IS NULL")
def missing_value_rows(spark: SparkSession, folder: str) -> DataFrame:
    return p.rows_with_missing(_events(spark, folder), ["user_id"]).select("event_id", "user_id", "event_type")


@query("profile_duplicates", f"""
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS repeated_rows
FROM (SELECT count(*) AS n FROM {EVENTS_SQL} GROUP BY user_id, event_type)""")
def profile_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return p.repeated_rows(_events(spark, folder).select("user_id", "event_type"))


@query("id_uniqueness", """
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS repeated_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def id_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return p.repeated_rows(tables.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("whitespace_audit", " UNION ALL ".join(
    f"""SELECT '{column}' AS "column", count(*) FILTER ({strip(f'"{column}"')} <> "{column}") AS rows_with_spaces
        FROM ({raw_sql('source_b/clientes')}) HAVING rows_with_spaces > 0"""
    for column in named("source_b/clientes").columns))
def whitespace_audit(spark: SparkSession, folder: str) -> DataFrame:
    extract = named("source_b/clientes")
    return p.whitespace_profile(RawExtracts(spark, folder)[extract.name].select(*extract.columns))


@query("uneven_spacing", f"""
SELECT "IdCliente", "NombreCompleto" FROM ({raw_sql('source_b/clientes')})
WHERE {strip('"NombreCompleto"')} <> "NombreCompleto" OR contains("NombreCompleto", '  ')""")
def uneven_spacing(spark: SparkSession, folder: str) -> DataFrame:
    customers = RawExtracts(spark, folder)["source_b/clientes"]
    return p.uneven_spacing(customers, "NombreCompleto").select("IdCliente", "NombreCompleto")


# Line items as payments of their order.
PAID = """
SELECT l_orderkey AS invoice, l_linenumber AS line, cast(cast(l_extendedprice AS decimal(12,2)) AS decimal(37,12)) AS amount FROM {lineitem}"""
DUE = "SELECT o_orderkey AS invoice, cast(cast(o_totalprice AS decimal(12,2)) AS decimal(37,12)) AS total FROM {orders}"
PAID_SQL, DUE_SQL = f"({PAID.format(lineitem='lineitem')})", f"({DUE.format(orders='orders')})"
OVERPAID_SQL = f"""
SELECT invoice, CAST(sum(amount) AS DECIMAL(38,12)) AS total_paid, total AS invoice_total,
       CAST(round(sum(amount) - total, 2) AS DECIMAL(38,2)) AS excess
FROM {PAID_SQL} JOIN {DUE_SQL} USING (invoice) GROUP BY invoice, total HAVING excess > 0.01"""


def _paid(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PAID, lineitem=tables.table(spark, folder, "lineitem"))


def _due(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(DUE, orders=tables.table(spark, folder, "orders"))


@query("multi_payment", f"SELECT invoice, count(*) AS payments FROM {PAID_SQL} GROUP BY invoice HAVING count(*) > 1")
def multi_payment(spark: SparkSession, folder: str) -> DataFrame:
    return p.frequent_keys(_paid(spark, folder), "invoice", "payments")


@query("overpaid", OVERPAID_SQL)
def overpaid(spark: SparkSession, folder: str) -> DataFrame:
    found = p.overpaid(_paid(spark, folder), _due(spark, folder), "invoice", "amount", "total")
    return found.select("invoice", F.col("total_paid").cast("decimal(38,12)").alias("total_paid"), "invoice_total",
                        F.col("excess").cast("decimal(38,2)").alias("excess"))


@query("overpaid_detail", f"SELECT * FROM {PAID_SQL} WHERE invoice IN (SELECT invoice FROM ({OVERPAID_SQL})) ORDER BY invoice, line")
def overpaid_detail(spark: SparkSession, folder: str) -> DataFrame:
    paid = _paid(spark, folder)
    flagged = p.overpaid(paid, _due(spark, folder), "invoice", "amount", "total")
    return p.rows_of_keys(paid, flagged, "invoice").orderBy("invoice", "line")


@query("dup_members", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
def dup_members(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return p.members_of_repeats(rows, ["l_orderkey", "l_linenumber"])


SPLIT = """
SELECT o_orderkey, cast(o_totalprice AS decimal(18,4)) AS total, cast(o_orderkey % 50 AS decimal(18,4)) AS tax,
       cast(o_totalprice AS decimal(18,4)) - cast(o_orderkey % 50 AS decimal(18,4))
         + cast(CASE WHEN o_orderkey % 6 = 0 THEN 0.02 WHEN o_orderkey % 7 = 0 THEN 0.01 ELSE 0 END AS decimal(18,4)) AS subtotal
FROM {orders}"""


@query("arith_mismatch", f"SELECT o_orderkey FROM ({SPLIT.format(orders='orders')}) WHERE abs(subtotal + tax - total) > 0.01")
def arith_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(SPLIT, orders=tables.table(spark, folder, "orders"))
    return p.unequal_sums(rows, ["subtotal", "tax"], "total").select("o_orderkey")


@query("null_when", f"""
SELECT "MetodoPago", count(*) AS rows FROM ({raw_sql('source_b/pagos')}) WHERE "Banco" = '' GROUP BY ALL""")
def null_when(spark: SparkSession, folder: str) -> DataFrame:
    payments = RawExtracts(spark, folder)["source_b/pagos"]
    return p.frequency_where(payments, p.missing(payments, "Banco"), "MetodoPago")


@query("unexpected_missing_bank", f"""
SELECT "IdPago", "MetodoPago" FROM ({raw_sql('source_b/pagos')}) WHERE trim("Banco") = '' AND "Banco" = ''
AND {sql.clean('"MetodoPago"')} <> 'EFECTIVO'""")
def unexpected_missing_bank(spark: SparkSession, folder: str) -> DataFrame:
    payments = RawExtracts(spark, folder)["source_b/pagos"]
    return p.unexpected_missing(payments, "Banco", "MetodoPago", "EFECTIVO").select("IdPago", "MetodoPago")


def _codes(name: str, column: str) -> str:
    return f"SELECT DISTINCT {strip(column)} AS code FROM ({raw_sql(name)}) WHERE {column} <> ''"


SHARED_TAX = f"""({_codes('source_a/customers', 'tax_id')} INTERSECT {_codes('source_b/clientes', '"RFC"')})"""


@query("cross_source_overlap", f"SELECT code FROM {SHARED_TAX}")
def cross_source_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return job.customer_overlap(RawExtracts(spark, folder))


@query("cross_source_suppliers", f"""
({_codes('source_a/suppliers', 'tax_id')}) INTERSECT ({_codes('source_b/proveedores', '"NIT"')})""")
def cross_source_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return job.supplier_overlap(RawExtracts(spark, folder))


SHARED_NIT = f"""({_codes('source_a/suppliers', 'tax_id')} INTERSECT {_codes('source_b/proveedores', '"NIT"')})"""
SHARED_SIDES = [("source_a/customers", "tax_id", SHARED_TAX), ("source_b/clientes", "RFC", SHARED_TAX),
                ("source_a/suppliers", "tax_id", SHARED_NIT), ("source_b/proveedores", "NIT", SHARED_NIT)]


@query("cross_source_detail", " UNION ALL ".join(
    f"""SELECT '{name}' AS extract, "{named(name).id_column}" AS id, "{column}" AS code FROM ({raw_sql(name)})
        WHERE {strip(f'"{column}"')} IN (SELECT code FROM {shared})""" for name, column, shared in SHARED_SIDES))
def cross_source_detail(spark: SparkSession, folder: str) -> DataFrame:
    """The records of both sides, customers and suppliers, that share a tax id."""
    raw = RawExtracts(spark, folder)
    shared = {SHARED_TAX: cut(job.customer_overlap(raw)), SHARED_NIT: cut(job.supplier_overlap(raw))}
    parts = [p.rows_with_codes(raw[name], column, shared[codes]).select(
        F.lit(name).alias("extract"), F.col(named(name).id_column).alias("id"), F.col(column).alias("code"))
        for name, column, codes in SHARED_SIDES]
    return reduce(DataFrame.union, parts)


PRODUCT_CODES = {"SOURCE_A": _codes("source_a/products", "sku"), "SOURCE_B": _codes("source_b/productos", '"CodigoBarras"'),
                 "SOURCE_C": _codes("source_c/products_catalog", "product_code")}
OVERLAP_SQL = " UNION ALL ".join(
    [f"SELECT '{a}' AS sets, count(*) AS codes FROM ({q})" for a, q in PRODUCT_CODES.items()]
    + [f"SELECT '{a}&{b}', count(*) FROM (({PRODUCT_CODES[a]}) INTERSECT ({PRODUCT_CODES[b]}))"
       for a in PRODUCT_CODES for b in PRODUCT_CODES if a < b])


@query("pairwise_overlap", OVERLAP_SQL)
def pairwise_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return job.product_overlap(RawExtracts(spark, folder))


def _label(name: str) -> str:
    return f"'{named(name).source_system}' AS source, '{name.split('/')[1]}' AS \"table\""


MISSING_IDS = " UNION ALL ".join(
    f"""SELECT {_label(e.name)}, '{e.id_column}' AS "column", count(*) FILTER ({sql.clean(f'"{e.id_column}"')} = '') AS affected_rows
        FROM ({raw_sql(e.name)})""" for e in EXTRACTS)


@query("null_sweep", " UNION ALL ".join(
    f"""SELECT {_label(e.name)}, '{c}' AS "column", count(*) FILTER ({blank(f'"{c}"')}) AS null_count,
               round(count(*) FILTER ({blank(f'"{c}"')}) / count(*) * 100, 1) AS null_percent
        FROM ({raw_sql(e.name)}) HAVING null_count > 0""" for e in EXTRACTS for c in e.columns))
def null_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return job.table_profiles(RawExtracts(spark, folder))


def _bits(c: str) -> str:
    dates = " OR ".join(f"TRY_STRPTIME({c}, '{f}') IS NOT NULL" for f in sql.DATE_FORMATS.values())
    return (f"CASE WHEN regexp_matches({c}, '{p.WHOLE_TEXT}') THEN {p.WHOLE} WHEN regexp_matches({c}, '{p.DECIMAL_TEXT}') THEN {p.DECIMAL} "
            f"WHEN regexp_matches({c}, '{p.BOOL_TEXT}') THEN {p.BOOL} WHEN {dates} THEN {p.DATE} ELSE {p.TEXT} END")


@query("extract_types", " UNION ALL ".join(
    f"""SELECT {_label(e.name)}, '{c}' AS "column",
               CASE bit_or({_bits(f'"{c}"')}) FILTER (NOT {blank(f'"{c}"')})
                 WHEN 1 THEN 'bool' WHEN 2 THEN 'whole' WHEN 4 THEN 'decimal' WHEN 6 THEN 'decimal' WHEN 8 THEN 'date'
                 ELSE CASE WHEN bool_and({blank(f'"{c}"')}) THEN 'nothing' ELSE 'text' END END AS type,
               count(*) FILTER (NOT {blank(f'"{c}"')}) AS known, count(*) FILTER ({blank(f'"{c}"')}) AS missing
        FROM ({raw_sql(e.name)})""" for e in EXTRACTS for c in e.columns))
def extract_types(spark: SparkSession, folder: str) -> DataFrame:
    """What type the values of every column of every extract have together."""
    return job.column_types(RawExtracts(spark, folder))


@query("whitespace_sweep", " UNION ALL ".join(
    f"""SELECT {_label(e.name)}, '{c}' AS "column", count(*) FILTER ({strip(f'"{c}"')} <> "{c}") AS rows_with_spaces
        FROM ({raw_sql(e.name)}) HAVING rows_with_spaces > 0""" for e in EXTRACTS for c in e.columns))
def whitespace_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return job.whitespace(RawExtracts(spark, folder))


@query("missing_id_sweep", MISSING_IDS)
def missing_id_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return job.missing_ids(RawExtracts(spark, folder))


def _bad_date(name: str, column: str) -> str:
    pattern = {f.source: f.extra for f in named(name).dates()}[column]
    return f"count(*) FILTER (TRY_STRPTIME(\"{column}\", '{sql.DATE_FORMATS[pattern]}') IS NULL)"


INVALID_DATES = " UNION ALL ".join(
    f"""SELECT {_label(name)}, '{column}' AS "column", {_bad_date(name, column)} AS affected_rows FROM ({raw_sql(name)})"""
    for name, columns in job.SWEPT_DATES.items() for column in columns)


@query("invalid_date_sweep", INVALID_DATES)
def invalid_date_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return job.invalid_dates(RawExtracts(spark, folder))


ORPHANS = " UNION ALL ".join(
    f"""SELECT {_label(child)}, '{key}' AS "column", count(*) AS affected_rows FROM ({raw_sql(child)}) c
        WHERE NOT EXISTS (SELECT 1 FROM ({raw_sql(parent)}) p WHERE p."{parent_key}" = c."{key}")"""
    for child, key, parent, parent_key in job.RELATIONS)


@query("fk_orphans", ORPHANS)
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return job.orphan_counts(RawExtracts(spark, folder))


LOOKED_UP = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 1
       WHEN l_partkey % 11 = 0 THEN -l_suppkey ELSE l_suppkey END AS supplier FROM {lineitem}"""


@query("lookup_salted", f"""
SELECT l_orderkey, l_linenumber, supplier, s_name FROM ({LOOKED_UP.format(lineitem='lineitem')})
LEFT JOIN supplier ON s_suppkey = supplier""")
def lookup_salted(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the rows has one key, others have none; the keys are salted however small the parents are."""
    rows = spark.sql(LOOKED_UP, lineitem=tables.table(spark, folder, "lineitem"))
    return joins.lookup(rows, tables.table(spark, folder, "supplier"), {"supplier": "s_suppkey"}, {"s_name": "s_name"},
                        small=False, hot_rows=500)


@query("orphan_rows", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""")
def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items whose order is not among the open ones."""
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.orphans(lines, tables.table(spark, folder, "orders").filter("o_orderstatus <> 'F'"),
                         {"l_orderkey": "o_orderkey"})


def _amount(name: str, column: str) -> str:
    if name == "source_b/pagos":
        return f"TRY_CAST(replace(replace(\"{column}\", '.', ''), ',', '.') AS DECIMAL(37,12))"
    return f'TRY_CAST("{column}" AS DECIMAL(37,12))'


def _overpaid_count(payments: str, key: str, amount: str, invoices: str, total: str) -> str:
    invoice_id = named(invoices).id_column
    return (f"SELECT count(*) FROM (SELECT \"{key}\" AS k, sum({_amount(payments, amount)}) AS s FROM ({raw_sql(payments)}) "
            f"WHERE \"{key}\" <> '' GROUP BY 1) JOIN (SELECT \"{invoice_id}\" AS k, "
            f"TRY_CAST(\"{total}\" AS DECIMAL(37,12)) AS t FROM ({raw_sql(invoices)})) USING (k) WHERE round(s - t, 2) > 0.01")


def _repeat_count(name: str) -> str:
    keys = ", ".join(f'"{k}"' for k in job.PAYMENT_KEYS[name])
    return f"SELECT sum(n) FROM (SELECT count(*) AS n FROM ({raw_sql(name)}) GROUP BY {keys}) WHERE n > 1"


def _multi_count(name: str) -> str:
    key = job.PAYMENT_KEYS[name][0]
    return (f"SELECT count(*) FROM (SELECT 1 FROM ({raw_sql(name)}) WHERE \"{key}\" <> '' "
            f"GROUP BY \"{key}\" HAVING count(*) > 1)")


def _orphan_count(child: str, key: str, parent: str) -> str:
    parent_key = named(parent).id_column
    return (f"SELECT count(*) FROM ({raw_sql(child)}) c WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({raw_sql(parent)}) p WHERE p.\"{parent_key}\" = c.\"{key}\")")


def _value_count(check: job.RowCheck) -> str:
    parts = []
    for column in [f'"{c}"' for c in check.columns]:
        tests = {"missing": f"{column} = ''", "spaces": f"{strip(column)} <> {column}",
                 "uneven": f"{strip(column)} <> {column} OR contains({column}, '  ')",
                 "comma": f"contains({column}, ',')", "sign": f"contains({column}, '$')"}
        parts.append(f"count(*) FILTER ({tests[check.kind]})")
    return f"SELECT {' + '.join(parts)} FROM ({raw_sql(check.extract)})"


def _finding_sql(source: str, table: str, issue: str, tolerance: str, action: str, count: str) -> str:
    return (f"SELECT '{source}' AS source, '{table}' AS \"table\", '{issue}' AS issue, "
            f"CAST(coalesce(({count}), 0) AS BIGINT) AS affected_rows, '{tolerance}' AS tolerance, '{action}' AS action")


def _findings_sql() -> str:
    rows = [_finding_sql(named(c.extract).source_system, c.extract.split("/")[1], c.issue, c.tolerance, c.action,
                         _value_count(c)) for c in job.ROW_CHECKS]
    gone = ("unknown customer", "CERO", "exclude the invoice and its dependents")
    over = ("payments exceed the invoice total", "CERO", "exclude the payments beyond it")
    multi = ("invoices with several payments", "CRITERIO", "accept within the invoice total")
    again = ("repeated payments", "CRITERIO", "keep the first of equal business keys")
    both = ("tax id in both sources", "CRITERIO", "keep both records")
    rows += [
        _finding_sql("SOURCE_A", "invoices", *gone, _orphan_count("source_a/invoices", "customer_id", "source_a/customers")),
        _finding_sql("SOURCE_B", "facturas", *gone, _orphan_count("source_b/facturas", "IdCliente", "source_b/clientes")),
        _finding_sql("SOURCE_A", "payments", *over, _overpaid_count(
            "source_a/payments", "invoice_id", "amount", "source_a/invoices", "total_amount")),
        _finding_sql("SOURCE_B", "pagos", *over, _overpaid_count(
            "source_b/pagos", "IdFactura", "Monto", "source_b/facturas", "Total")),
        _finding_sql("SOURCE_A", "payments", *multi, _multi_count("source_a/payments")),
        _finding_sql("SOURCE_B", "pagos", *multi, _multi_count("source_b/pagos")),
        _finding_sql("SOURCE_A", "payments", *again, _repeat_count("source_a/payments")),
        _finding_sql("SOURCE_B", "pagos", *again, _repeat_count("source_b/pagos")),
        _finding_sql("GLOBAL", "all_sources", "missing source id", "CERO", "exclude the row",
                     f"SELECT sum(affected_rows) FROM ({MISSING_IDS})"),
        _finding_sql("GLOBAL", "date_fields", "missing or invalid date", "ALTA", "use 1900-01-01",
                     f"SELECT sum(affected_rows) FROM ({INVALID_DATES})"),
        _finding_sql("CROSS", "customers", *both, f"SELECT count(*) FROM {SHARED_TAX}"),
        _finding_sql("CROSS", "suppliers", *both,
                     f"SELECT count(*) FROM (({_codes('source_a/suppliers', 'tax_id')}) INTERSECT "
                     f"({_codes('source_b/proveedores', chr(34) + 'NIT' + chr(34))}))"),
        _finding_sql("CROSS", "products", "no common product code", "CRITERIO", "keep every product with its source",
                     f"SELECT sum(codes) FROM ({OVERLAP_SQL}) WHERE NOT contains(sets, '&')"),
    ]
    return " UNION ALL ".join(rows)


@query("findings", _findings_sql())
def findings(spark: SparkSession, folder: str) -> DataFrame:
    return job.findings(RawExtracts(spark, folder))


@query("row_profiles", " UNION ALL ".join(
    f"""SELECT {_label(e.name)}, {len(e.columns)} AS column_count, (SELECT count(*) FROM ({raw_sql(e.name)})) AS row_count,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM
          ({raw_sql(e.name)}) GROUP BY {', '.join(f'"{c}"' for c in e.columns)})) AS repeated_rows,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM ({raw_sql(e.name)})
          GROUP BY "{e.id_column}")) AS repeated_ids""" for e in EXTRACTS))
def row_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return job.row_profiles(RawExtracts(spark, folder))


# Payments with repeats, ordered by a unique position.
PAYMENTS = f"""
SELECT l_orderkey AS invoice, cast(l_shipdate AS date) AS paid_on, cast(cast(l_extendedprice AS decimal(12,2)) AS decimal(37,12)) AS amount,
       l_returnflag AS method, {PAYMENT_SEQ} AS seq FROM {PAYMENT_ROWS} AS p"""
PAYMENTS_SQL = f"({PAYMENTS.format(lineitem='lineitem')})"


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    """Written once: the cap goes over its rows several times."""
    return cut(spark.sql(PAYMENTS, lineitem=spread(tables.table(spark, folder, "lineitem"))))


@query("dedupe_exact", f"""
SELECT invoice, seq, row_number() OVER (PARTITION BY invoice, paid_on, amount, method ORDER BY seq) = 1 AS first
FROM {PAYMENTS_SQL}""")
def dedupe_exact(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(PAYMENTS, lineitem=spread(tables.table(spark, folder, "lineitem")))
    return mark_first(rows, ["invoice", "paid_on", "amount", "method"], "seq", "first").select(
        "invoice", "seq", "first")


@query("capped_payments", f"""
WITH RECURSIVE ranked AS MATERIALIZED (
  SELECT p.invoice, seq, amount, total AS cap, row_number() OVER (PARTITION BY p.invoice ORDER BY seq) AS place
  FROM {PAYMENTS_SQL} p JOIN {DUE_SQL} d ON p.invoice = d.invoice),
walk AS (
  SELECT invoice, seq, place, amount <= cap AS accepted, CASE WHEN amount <= cap THEN amount ELSE 0 END AS paid
  FROM ranked WHERE place = 1
  UNION ALL
  SELECT r.invoice, r.seq, r.place, w.paid + r.amount <= r.cap,
         CASE WHEN w.paid + r.amount <= r.cap THEN w.paid + r.amount ELSE w.paid END
  FROM walk w JOIN ranked r ON r.invoice = w.invoice AND r.place = w.place + 1)
SELECT invoice, seq, accepted FROM walk""")
def capped_payments(spark: SparkSession, folder: str) -> DataFrame:
    due = joins.lookup(_payments(spark, folder), _due(spark, folder), {"invoice": "invoice"}, {"cap": "total"})
    return accept_within_cap(due, ["invoice"], "seq", "amount", "cap", "accepted").select("invoice", "seq", "accepted")


# The whole event stream counts against one cap per event type: a few very long groups, with refunds.
STREAM = """
SELECT event_id, event_type,
       CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END * cast(cast(value AS decimal(12,2)) AS decimal(37,12)) AS amount,
       cast(1000 AS decimal(37,12)) AS cap FROM {events}"""


@query("capped_long_groups", f"""
WITH RECURSIVE ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place
  FROM ({STREAM.format(events='events')})),
walk AS (
  SELECT event_id, event_type, place, amount <= cap AS accepted, CASE WHEN amount <= cap THEN amount ELSE 0 END AS paid
  FROM ranked WHERE place = 1
  UNION ALL
  SELECT r.event_id, r.event_type, r.place, w.paid + r.amount <= r.cap,
         CASE WHEN w.paid + r.amount <= r.cap THEN w.paid + r.amount ELSE w.paid END
  FROM walk w JOIN ranked r ON r.event_type = w.event_type AND r.place = w.place + 1)
SELECT event_id, event_type, accepted FROM walk""")
def capped_long_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups far beyond the folding limit, which is lowered so that small tables get there too."""
    rows = spark.sql(STREAM, events=tables.table(spark, folder, "events"))
    return accept_within_cap(rows, ["event_type"], "event_id", "amount", "cap", "accepted", fold_rows=256,
                             chunk_rows=max(1, rows.count() // 10)).select("event_id", "event_type", "accepted")
