from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import events as ev
from ledgerloom.operators.keys import assign_by_position
from ledgerloom.operators.payments import mark_first
from ledgerloom.plans import conform as job
from ledgerloom.plans import profile, publish
from ledgerloom.plans.publish import counted
from ledgerloom.plans.staging import accepted
from ledgerloom.session import cut, fresh_path, run_folder, scratch
from ledgerloom.sources import files
from ledgerloom.sources.extracts import by_source
from ledgerloom.sources.schemas import not_null_violations, star_schema
from ledgerloom.sources.storage import Folder
from tests.extract_files import write_files


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write_files(tmp_path_factory.mktemp("extracts"))


@pytest.fixture(scope="module")
def staged(spark, folder, tmp_path_factory):
    return job.conform(files.read_all(spark, folder), stage_to=str(tmp_path_factory.mktemp("stage")))


@pytest.fixture(scope="module")
def published(spark, staged, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    first = publish.publish(staged, out, "v1", datetime(2026, 1, 1))
    again = publish.publish(staged, out, "v2", datetime(2026, 1, 2))
    assert first == again
    return out, again


def test_missing_files_are_all_named(spark, tmp_path):
    folder = write_files(tmp_path)
    (tmp_path / "source_b/pagos.csv").unlink()
    (tmp_path / "source_c/products_catalog.csv").unlink()
    with pytest.raises(FileNotFoundError, match="lacks 2 of 13 extracts: source_b/pagos.csv, source_c/products_catalog.csv"):
        files.validate_files(spark, folder)
    assert [len(by_source(s)) for s in ("SOURCE_A", "SOURCE_B", "SOURCE_C")] == [6, 6, 1]


@pytest.mark.parametrize(("encoding", "strict", "name"), [
    ("utf-8", False, "Marisol  Ibañez Paz"), ("latin-1", False, "Marisol  Ibañez Paz"),
    ("latin-1", True, "Marisol  Ibañez Paz"), ("utf-8", True, "Marisol  IbaÃ±ez Paz")])
def test_encodings_of_the_legacy_source(spark, tmp_path, encoding, strict, name):
    raw = files.read_all(spark, write_files(tmp_path, encoding), strict_encoding=strict)
    assert raw["source_b/clientes"].filter("IdCliente = 'C1'").first().NombreCompleto == name


def test_bare_quotes_and_file_order(spark, folder):
    raw = files.read_all(spark, folder)
    rows = raw["source_a/products"].orderBy(files.SEQUENCE).collect()
    assert [r.product_id for r in rows] == ["P1", "P2"] and rows[0].product_name == 'Desk lamp 8" arm'


def test_accepted_rows(staged):
    counts = {t: accepted(df).count() for t, df in staged.items()}
    assert counts == {"Customers": 5, "Suppliers": 2, "Products": 4, "Invoices": 3, "InvoiceLines": 3, "Payments": 4}


def test_values(staged):
    rows = {(r.source_system, r.source_id): r for r in accepted(staged["Products"]).collect()}
    assert rows[("SOURCE_A", "P1")].uom == "UNIDAD" and rows[("SOURCE_A", "P2")].created_date is None
    assert rows[("SOURCE_B", "P1")].unit_price == Decimal("2318.45")
    assert rows[("SOURCE_C", "SKU-1")].unit_price == Decimal("1089.99")
    invoice = accepted(staged["Invoices"]).filter("source_id = 'I3'").first()
    assert (invoice.invoice_date, invoice.status, invoice.subtotal) == (date(1900, 1, 1), "PENDING", Decimal(100))
    name = accepted(staged["Customers"]).filter("source_system = 'SOURCE_B' AND source_id = 'B2'").first()
    assert (name.first_name, name.last_name, name.is_active) == ("Ana", "NO DISPONIBLE", False)


def test_payment_verdicts(staged):
    got = {r.source_id: r._reject for r in staged["Payments"].collect()}
    over, repeat = "Pago excede el total acumulado de la factura", "Pago duplicado exacto"
    assert got == {"Y1": None, "Y2": None, "Y3": over, "Y4": repeat, "Y5": None, "Y6": "Pago con factura inexistente",
                   "Y7": repeat, "G1": None, "G2": over}


def test_events_follow_the_order_of_checks(staged):
    events = job.quality_events(staged)
    assert events.columns == ["table", "source_system", "source_id", "action", "reason", "field", "original_value", "new_value"]
    by_id = {}
    for e in events.collect():
        by_id.setdefault((e.table, e.source_system, e.source_id), []).append(e)
    # An orphan reports nothing about its own values.
    assert [e.reason for e in by_id[("Invoices", "SOURCE_A", "I2")]] == ["Factura con cliente inexistente"]
    assert [e.reason for e in by_id[("Payments", "SOURCE_A", "Y6")]] == ["Pago con factura inexistente"]
    missing = by_id[("Customers", "SOURCE_A", "  ")]
    assert [(e.reason, e.field) for e in missing] == [("Registro sin ID de origen", "customer_id")]
    over = by_id[("Payments", "SOURCE_A", "Y3")][0]
    assert (over.field, over.original_value) == ("amount", "150")
    repeat = by_id[("Payments", "SOURCE_A", "Y4")][0]
    assert (repeat.field, repeat.original_value) == ("dedupe_key", "SOURCE_A|I1|2024-01-08|150.0|CARD|R3")
    assert ("InvoiceLines", "SOURCE_A", "L4") in by_id
    twice = [e.reason for e in by_id[("Customers", "SOURCE_A", "C2")]]
    assert sorted(twice) == ["Decimal invalido", "Email vacio", "Fecha invalida", "Fecha vacia", "Texto obligatorio vacio",
                             "Whitespace normalizado"]


def test_no_parent_accepted_excludes_all_children(spark, folder):
    raw = files.read_all(spark, folder)
    raw["source_a/customers"] = raw["source_a/customers"].limit(0)
    raw["source_b/clientes"] = raw["source_b/clientes"].limit(0)
    staged = job.conform(raw)
    assert [accepted(staged[t]).count() for t in ("Invoices", "InvoiceLines", "Payments")] == [0, 0, 0]


def test_published_tables(spark, published):
    out, counts = published
    assert counts == {"Customers": 5, "Suppliers": 2, "Products": 4, "Invoices": 3, "InvoiceLines": 3, "Payments": 4}
    tables = publish.current(spark, out)
    assert tables["Customers"].first().created_at == datetime(2026, 1, 2)
    for name, df in tables.items():
        assert df.agg(F.sum(not_null_violations(df, star_schema(name)))).first()[0] == 0
        key = publish.KEYS[name]
        assert sorted(r[0] for r in df.select(key).collect()) == list(range(1, df.count() + 1))


def test_keys_resolve_within_their_source(spark, published):
    tables = publish.current(spark, published[0])
    customers = {(r.customer_id): (r.source_system, r.first_name) for r in tables["Customers"].collect()}
    invoices = {(r.source_system, r.source_id): customers[r.customer_id] for r in tables["Invoices"].collect()}
    # C2 occurs twice in one source; the last one stands for it.
    assert invoices == {("SOURCE_A", "I1"): ("SOURCE_A", "Ann"), ("SOURCE_A", "I3"): ("SOURCE_A", "Bobby"),
                        ("SOURCE_B", "I1"): ("SOURCE_B", "Marisol")}
    products = {(r.source_system, r.source_id): r.supplier_id for r in tables["Products"].collect()}
    assert products[("SOURCE_A", "P1")] == 1
    assert [products[k] for k in (("SOURCE_A", "P2"), ("SOURCE_B", "P1"), ("SOURCE_C", "SKU-1"))] == [None] * 3


def test_failed_run_keeps_the_published_version(spark, staged, published):
    out, _ = published
    with pytest.raises(KeyError):
        publish.publish({k: v for k, v in staged.items() if k != "Payments"}, out, "v3", datetime(2026, 1, 3))
    assert publish.current(spark, out)["Payments"].first().created_at == datetime(2026, 1, 2)


def test_published_version_is_not_written_over(staged, published):
    with pytest.raises(ValueError, match="v2 is published"):
        publish.publish(staged, published[0], "v2", datetime(2026, 1, 4))


def rewrite(folder, path, change):
    target = folder / path
    target.write_text(change(target.read_text()))


def test_quoted_line_breaks(spark, tmp_path):
    folder = write_files(tmp_path)
    rewrite(tmp_path, "source_a/suppliers.csv", lambda t: t.replace("S1,Acme,,", 'S1,"Ac\nme",,') + "S2,Bolt,,,,,,,,,1\n")
    extract = next(e for e in files.EXTRACTS if e.name == "source_a/suppliers")
    rows = files.read_extract(spark, folder, extract, line_breaks=True).collect()
    assert [(r.supplier_id, r.company_name) for r in rows] == [("S1", "Ac\nme"), ("S2", "Bolt")]
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_extract(spark, folder, extract).collect()


def test_columns_are_found_by_name(spark, tmp_path):
    folder = write_files(tmp_path)
    rewrite(tmp_path, "source_a/suppliers.csv", lambda t: t.replace("supplier_id,company_name", "company_name,supplier_id")
            .replace("is_active\n", "is_active,extra\n").replace("NET30,1", "NET30,1,more"))
    extract = next(e for e in files.EXTRACTS if e.name == "source_a/suppliers")
    row = files.read_extract(spark, folder, extract).first()
    assert (row.supplier_id, row.company_name, row.is_active) == ("Acme", "S1", "1") and "extra" not in row
    rewrite(tmp_path, "source_a/suppliers.csv", lambda t: t.replace("tax_id", "vat"))
    with pytest.raises(ValueError, match="no column tax_id"):
        files.read_extract(spark, folder, extract)


@pytest.mark.parametrize("row", ["S9,Short", "S9" + "," * 11])
def test_rows_of_another_length_are_errors(spark, tmp_path, row):
    folder = write_files(tmp_path)
    rewrite(tmp_path, "source_a/suppliers.csv", lambda t: t + row + "\n")
    extract = next(e for e in files.EXTRACTS if e.name == "source_a/suppliers")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_extract(spark, folder, extract).select("supplier_id").collect()


def test_audit_trail_keeps_original_values(spark, tmp_path):
    originals = [" Ann ", "   ", "  nice  ", "Ac\nme  x", 'say "hi", ok', "tab\tend\t", "", "\r\n", "\\", "a\rb"]
    rows = [("Suppliers", "SOURCE_A", str(k), "cleaned", "Whitespace normalizado", "f", o, o.strip()) for k, o in enumerate(originals)]
    events = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in publish.ev.EVENT_COLUMNS))
    publish.write_quality(events, str(tmp_path))
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_path}/quality_report_csv", events.schema).fillna("").collect())) == sorted(rows)
    logged = spark.read.schema(events.schema).json(f"{tmp_path}/quality_report_json/events")
    assert sorted(map(tuple, logged.collect())) == sorted(rows)
    totals = spark.read.json(f"{tmp_path}/quality_report_json/totals_by_action").collect()
    assert [(r.action, r.events) for r in totals] == [("cleaned", len(rows))]


def test_quality_report_and_pending_export(spark, staged, tmp_path):
    publish.write_quality(job.quality_events(staged), str(tmp_path / "q"))
    totals = {r.action: r.events for r in spark.read.json(str(tmp_path / "q/quality_report_json/totals_by_action")).collect()}
    assert totals == {r.action: r["count"] for r in job.quality_events(staged).groupBy("action").count().collect()}
    assert spark.read.json(str(tmp_path / "q/quality_report_json/decisions")).count() == 3
    pending = publish.export_pending(staged, str(tmp_path / "p"))
    assert pending["Payments_pending_rows"] == 4 and (tmp_path / "p/README.txt").exists()
    header = spark.read.option("header", True).csv(str(tmp_path / "p/InvoiceLines")).columns
    assert "invoice_code" in header and "_events" not in header


def test_payments_are_planned_once_where_all_have_a_position(spark, folder):
    raw = files.read_all(spark, folder)
    invoices = job.conform(raw, ("Invoices",))["Invoices"]
    rows = job.staged_table(raw, "Payments")

    def checked(lost):
        place = F.when(F.col("source_id") != lost, F.col(files.SEQUENCE))
        return job.check_payments(rows.withColumn(files.SEQUENCE, place), invoices)

    def reads(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("] csv")

    def verdicts(df):
        return {r.source_id: r._reject for r in df.collect()}

    usual, orphan = checked("none of them"), checked("Y6")
    assert reads(usual) == 2 and reads(orphan) > 2
    # An orphan is one without a position too.
    assert verdicts(usual) == verdicts(orphan) and verdicts(orphan)["Y6"] == "Pago con factura inexistente"
    assert verdicts(checked("Y3"))["Y3"] is None


def test_payments_are_cleaned_once_for_their_checks(spark, folder, monkeypatch):
    raw, seen = files.read_all(spark, folder), []
    monkeypatch.setattr(job, "mark_first", lambda rows, *a: seen.append(rows) or mark_first(rows, *a))
    verdicts = {r.source_id: r._reject for r in job.conform(raw, ("Payments",))["Payments"].collect()}
    assert "csv" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert verdicts["Y4"] == "Pago duplicado exacto" and verdicts["Y1"] is None
    # The copy that was read is gone.
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST"):
        seen[0].count()


def payment_rows(spark, count=300):
    """Payments of 20 invoices, the last two of which do not exist; most come again, and two orphans have one position."""
    rows = [("S", f"P{n}", f"I{n % 20}", date(2026, 1, 1), Decimal(n // 40), str(n // 40), None, f"R{n // 40}",
             119 if n == 118 else n) for n in range(count)]
    payments = spark.createDataFrame(rows, "source_system string, source_id string, invoice_code string, payment_date date, "
                                           "amount decimal(38,12), amount_text string, payment_method string, reference_number string, _seq long")
    payments = payments.withColumns({"_reject": F.lit(None).cast("string"), "_events": ev.no_events()})
    invoices = spark.createDataFrame([("S", f"I{n}", n, Decimal(3 * n), None) for n in range(18)],
                                     "source_system string, source_id string, _seq long, total_amount decimal(38,12), _reject string")
    return payments, invoices


def test_payments_judged_in_slices_get_the_same_verdicts(spark, monkeypatch):
    payments, invoices = payment_rows(spark)

    def judged(**sizes):
        return sorted((r.source_id, str(r._reject), str(r._events)) for r in job.check_payments(payments, invoices, **sizes).collect())

    whole = judged()
    assert len(whole) == 300
    assert {r[1] for r in whole} == {"None", ev.ORPHAN_PAYMENT, ev.DUPLICATE_PAYMENT, ev.OVER_CAP}
    calls = []
    monkeypatch.setattr(job, "mark_first", lambda rows, *a: calls.append(1) or mark_first(rows, *a))
    assert judged(slice_bytes=3000) == whole
    assert len(calls) > 2


def kept_folders(spark):
    return set(Folder(spark, run_folder(spark)).folders())


def test_checks_of_payments_keep_totals_and_verdicts_only(spark):
    payments, invoices = payment_rows(spark)
    before = kept_folders(spark)
    checked = job.check_payments(payments, invoices)
    assert len(kept_folders(spark) - before) == 2
    assert checked.count() == 300


def test_publishing_keeps_no_other_files(spark, staged, tmp_path):
    before = kept_folders(spark)
    publish.publish(staged, str(tmp_path / "star"), "v1", datetime(2026, 1, 1))
    assert kept_folders(spark) == before


def test_only_published_columns_are_written_on_the_way(spark, staged, monkeypatch):
    seen = []
    monkeypatch.setattr(publish, "assign_by_position", lambda rows, *a: seen.append(rows.columns) or assign_by_position(rows, *a))
    assert publish.build_table("Suppliers", staged["Suppliers"], {}, datetime(2026, 1, 1)).count() > 0
    assert "_events" not in seen[0] and "table" not in seen[0] and files.SEQUENCE in seen[0]


def test_pending_payments_are_written_once_and_first(spark, staged, tmp_path, monkeypatch):
    order = []
    monkeypatch.setattr(publish, "counted", lambda name, *a: order.append(name) or counted(name, *a))
    counts = publish.export_pending(staged, str(tmp_path))
    assert order[0] == "Payments" and list(counts) == [f"{t}_pending_rows" for t in job.TABLES]


def test_written_log_is_the_log_without_the_cleaning(spark, folder):
    staged = job.conform(files.read_all(spark, folder))
    log, written = job.quality_events(staged), job.written_events(staged)
    assert "csv" not in written._jdf.queryExecution().optimizedPlan().toString()
    assert written.columns == log.columns
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, log.collect()))
    assert job.written_events({"Customers": staged["Customers"]}).select("table").distinct().collect() == [("Customers",)]


def test_driver_is_released_after_every_table(staged, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(publish, "release", calls.append)
    publish.publish(staged, str(tmp_path / "star"), "v1", datetime(2026, 1, 1))
    assert len(calls) == 6
    publish.export_pending(staged, str(tmp_path / "pending"))
    assert len(calls) == 12


def test_profile(spark, folder):
    found = {(r.source, r.table, r.issue): r.affected_rows for r in profile.findings(files.read_all(spark, folder)).collect()}
    assert len(found) == 28
    assert found[("SOURCE_A", "customers", "missing email")] == 1
    assert found[("SOURCE_A", "customers", "extra spaces")] == 3
    assert found[("SOURCE_A", "payments", "payments exceed the invoice total")] == 1
    assert found[("SOURCE_A", "payments", "invoices with several payments")] == 1
    assert found[("SOURCE_B", "pagos", "missing bank")] == 1
    assert found[("GLOBAL", "all_sources", "missing source id")] == 1
    assert found[("CROSS", "customers", "tax id in both sources")] == 1


def test_profile_tables_build(spark, folder):
    tables = profile.profile(files.read_all(spark, folder))
    overlap = {r.sets: r.codes for r in tables["product_overlap"].collect()}
    assert overlap["SOURCE_A&SOURCE_C"] == 1 and overlap["SOURCE_A"] == 2
    assert tables["overpaid_b"].count() == 0
    repeated = {(r.source, r.table): r.repeated_ids for r in tables["row_profiles"].collect()}
    assert repeated[("SOURCE_A", "customers")] == 1


def test_scratch_deletes_what_is_cut_inside(spark):
    kept = fresh_path(spark)
    with scratch(spark):
        inner = cut(spark.range(5))
        with scratch(spark):
            cut(inner)
        outer = cut(inner, kept)
    assert outer.count() == 5
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST"):
        inner.count()


def test_tables_without_rows_are_not_written(spark, staged, tmp_path):
    without = staged | {"Payments": staged["Payments"].limit(0)}
    out = str(tmp_path / "star")
    counts = publish.publish(without, out, "v1", datetime(2026, 1, 2))
    assert counts["Payments"] == 0 and counts["Customers"] == 5
    assert not (tmp_path / "star/versions/v1/Payments").exists()
    assert publish.current(spark, out)["Payments"].collect() == []
    pending = publish.export_pending(without, str(tmp_path / "pending"))
    assert pending["Payments_pending_rows"] == 0 and pending["Customers_pending_rows"] == 5
    assert not (tmp_path / "pending/Payments").exists() and (tmp_path / "pending/Customers").exists()
