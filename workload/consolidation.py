"""The consolidation run over extracts derived from the given tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import events as ev
from ledgerloom.operators.keys import assign_by_position
from ledgerloom.plans import conform as job
from ledgerloom.plans.publish import KEYS, REFERENCES, build_table, current, export_pending, publish, resolve, write_quality
from ledgerloom.plans.staging import accepted, staged_types
from ledgerloom.session import cut, fresh_path, release, remove_path, scratch
from ledgerloom.sources import files
from ledgerloom.sources.extracts import EXTRACTS, TABLES, named
from workload.expected import ALL_EVENTS, consolidation
from workload.raw_extracts import RawExtracts, raw_sql
from workload.registry import query

LOADED_AT = datetime(2026, 1, 1)
STAGED = {"Customers": "customers_", "Suppliers": "suppliers_", "Products": "products_", "Invoices": "invoices_",
          "InvoiceLines": "lines_", "Payments": "payments_"}


def _columns(table: str) -> list[str]:
    return ["source_system", "source_id", *[c for c in staged_types(table) if c != "amount_text"]]


def _conformed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return job.conform(RawExtracts(spark, folder), (table,))[table]


def _register(table: str, name: str) -> None:
    columns = _columns(table)

    @query(f"conform_{name}", consolidation(
        f"SELECT {', '.join(columns)} FROM {STAGED[table]} WHERE reject IS NULL"))
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return accepted(_conformed(spark, folder, table)).select(*columns)


for _table, _name in (("Customers", "customers"), ("Suppliers", "suppliers"), ("Products", "products"),
                      ("Invoices", "invoices"), ("InvoiceLines", "invoice_lines"), ("Payments", "payments")):
    _register(_table, _name)


def _written_events(spark: SparkSession, folder: str) -> DataFrame:
    return job.written_events(job.conform(RawExtracts(spark, folder)))


@query("quality_events", consolidation(
    f'SELECT "table", source_system, source_id, e.action, e.reason, e.field, e.original_value, e.new_value FROM {ALL_EVENTS}'))
def quality_events(spark: SparkSession, folder: str) -> DataFrame:
    return _written_events(spark, folder)


@query("quality_by_action", consolidation(f"SELECT e.action, count(*) AS events FROM {ALL_EVENTS} GROUP BY ALL"))
def quality_by_action(spark: SparkSession, folder: str) -> DataFrame:
    return ev.totals_by(_written_events(spark, folder), "action")


@query("quality_by_table", consolidation(f'SELECT "table", count(*) AS events FROM {ALL_EVENTS} GROUP BY ALL'))
def quality_by_table(spark: SparkSession, folder: str) -> DataFrame:
    return ev.totals_by(_written_events(spark, folder), "table")


@query("quality_log_roundtrip", consolidation(
    f'SELECT "table", source_system, source_id, e.action, e.reason, e.field, e.original_value, e.new_value FROM {ALL_EVENTS}'))
def quality_log_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The log as it stands in the written CSV."""
    events, out = _written_events(spark, folder), fresh_path(spark)
    write_quality(events, out)
    return files.read_csv(spark, f"{out}/quality_report_csv", events.schema).fillna("")


def _line(columns: tuple[str, ...]) -> str:
    return "concat_ws('|', " + ", ".join(f'"{c}"' for c in columns) + ")"


@query("extract_roundtrip", " UNION ALL ".join(
    f"SELECT '{n}' AS extract, {_line(named(n).columns)} AS line FROM ({raw_sql(n)})" for n in [e.name for e in EXTRACTS]))
def extract_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All derived extracts, line breaks among their values, written as files and read by their headers."""
    raw, out = RawExtracts(spark, folder), fresh_path(spark)
    parts = []
    for extract in EXTRACTS:
        files.write_extract(raw[extract.name], out, extract)
        rows = files.read_extract(spark, out, extract, line_breaks=True)
        remove_path(spark, f"{out}/{extract.path}")  # its lines are cut off by now
        release(spark)
        parts.append(rows.select(F.lit(extract.name).alias("extract"), F.concat_ws("|", *extract.columns).alias("line")))
    return reduce(DataFrame.union, parts)


@query("missing_id_excluded", consolidation(" UNION ALL ".join(
    f'SELECT "table", source_system, source_id, reject AS reason FROM {t} WHERE reject = \'Registro sin ID de origen\''
    for t in ("customers_", "suppliers_", "products_", "invoices_raw", "lines_raw", "payments_raw"))))
def missing_id_excluded(spark: SparkSession, folder: str) -> DataFrame:
    raw = RawExtracts(spark, folder)
    parts = [job.staged_table(raw, t).select("table", "source_system", "source_id", "_reject") for t in TABLES]
    rows = reduce(DataFrame.union, parts)
    return rows.filter(F.col("_reject") == ev.MISSING_ID).withColumnRenamed("_reject", "reason")


def _verdicts(rows: DataFrame) -> DataFrame:
    return rows.select("source_system", "source_id", F.col("_reject").alias("reject"))


@query("fk_accept_invoices", consolidation("SELECT source_system, source_id, reject FROM invoices_"))
def fk_accept_invoices(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_conformed(spark, folder, "Invoices"))


@query("fk_cascade_lines", consolidation("SELECT source_system, source_id, reject FROM lines_"))
def fk_cascade_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_conformed(spark, folder, "InvoiceLines"))


@query("payment_verdicts", consolidation("SELECT source_system, source_id, reject FROM payments_"))
def payment_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_conformed(spark, folder, "Payments"))


@query("union_conformed", consolidation(
    "SELECT source_system, source_id, product_name, category, uom FROM products_ WHERE reject IS NULL"))
def union_conformed(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(_conformed(spark, folder, "Products")).select(
        "source_system", "source_id", "product_name", "category", "uom")


SUPPLIER_KEYS = """
(SELECT row_number() OVER (ORDER BY source_system, _seq) AS supplier_id, * FROM suppliers_ WHERE reject IS NULL)"""


@query("surrogate_keys", consolidation(
    """SELECT row_number() OVER (ORDER BY source_system, _seq) AS invoice_id, invoice_number, source_system, source_id
       FROM invoices_ WHERE reject IS NULL"""))
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(_conformed(spark, folder, "Invoices"))
    keyed = assign_by_position(rows.select("invoice_number", "source_system", "source_id", "_seq"), KEYS["Invoices"],
                               ["source_system"], "_seq")
    return keyed.drop("_seq")


@query("fk_resolve", consolidation(
    f"""SELECT p.source_system, p.source_id, p.supplier_code, k.supplier_id
        FROM products_ p LEFT JOIN (SELECT source_system, source_id, max(supplier_id) AS supplier_id
                                    FROM {SUPPLIER_KEYS} GROUP BY ALL) k
          ON k.source_system = p.source_system AND k.source_id = p.supplier_code
        WHERE p.reject IS NULL"""))
def fk_resolve(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = accepted(_conformed(spark, folder, "Suppliers")).select("source_system", "source_id", "_seq")
    keyed = assign_by_position(suppliers, "supplier_id", ["source_system"], "_seq")
    products = accepted(_conformed(spark, folder, "Products")).select("source_system", "source_id", "supplier_code")
    return resolve(products, keyed, "supplier_id", "supplier_code")


def _keyed(table: str) -> str:
    return f"(SELECT row_number() OVER (ORDER BY source_system, _seq) AS k, * FROM {STAGED[table]} WHERE reject IS NULL)"


def _reference_sql(table: str, key: str, parent: str, code: str) -> str:
    parents = f"(SELECT source_system, source_id, max(k) AS k FROM {_keyed(parent)} GROUP BY ALL)"
    return (f"SELECT '{table}' AS \"table\", '{key}' AS reference, c.source_system, c.source_id, p.k AS parent_key "
            f"FROM {STAGED[table]} c LEFT JOIN {parents} p ON p.source_system = c.source_system AND p.source_id = c.{code} "
            f"WHERE c.reject IS NULL")


@query("star_references", consolidation(" UNION ALL ".join(
    _reference_sql(table, *reference) for table, references in REFERENCES.items() for reference in references)))
def star_references(spark: SparkSession, folder: str) -> DataFrame:
    """All five foreign keys of the six published tables."""
    staged = job.conform(RawExtracts(spark, folder))
    tables: dict[str, DataFrame] = {}
    for table in TABLES:
        path = fresh_path(spark)
        with scratch(spark):
            tables[table] = cut(build_table(table, staged[table], tables, LOADED_AT), path)
        release(spark)
    parts = [tables[t].select(F.lit(t).alias("table"), F.lit(key).alias("reference"), "source_system", "source_id",
                              F.col(key).alias("parent_key"))
             for t, references in REFERENCES.items() for key, _, _ in references]
    return reduce(DataFrame.union, parts)


@query("star_counts", consolidation(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows, count(*) AS highest_key FROM {t} WHERE reject IS NULL" for n, t in STAGED.items())))
def star_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the published tables, and their highest key, which says that keys have no gaps."""
    staged, out = job.conform(RawExtracts(spark, folder)), fresh_path(spark)
    publish(staged, out, "v1", LOADED_AT)
    parts = [rows.agg(F.count("*").alias("rows"), F.max(KEYS[t]).cast("bigint").alias("highest_key"))
             .select(F.lit(t).alias("table"), "rows", "highest_key") for t, rows in current(spark, out).items()]
    return reduce(DataFrame.union, parts)


@query("reconcile_counts", consolidation(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {t} WHERE reject IS NULL" for n, t in STAGED.items())))
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table as they were counted while the version was written."""
    counts = publish(job.conform(RawExtracts(spark, folder)), fresh_path(spark), "v1", LOADED_AT)
    return spark.createDataFrame(list(counts.items()), "table string, rows long")


@query("pending_counts", consolidation(" UNION ALL ".join(
    f"SELECT '{n}_pending_rows' AS \"table\", count(*) AS rows FROM {t} WHERE reject IS NULL" for n, t in STAGED.items())))
def pending_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per CSV table that waits for its database, counted as they were written."""
    counts = export_pending(job.conform(RawExtracts(spark, folder)), fresh_path(spark))
    return spark.createDataFrame(list(counts.items()), "table string, rows long")
