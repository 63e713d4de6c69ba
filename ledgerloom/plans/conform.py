"""The consolidation: thirteen extracts to six conformed tables and their audit trail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import events as ev
from ledgerloom.operators.joins import HOT_ROWS, flag_known, latest_by_key, lookup
from ledgerloom.operators.payments import accept_within_cap, mark_first
from ledgerloom.plans.staging import accepted, stage
from ledgerloom.sources.extracts import TABLES, by_table
from ledgerloom.sources.files import SEQUENCE
from ledgerloom.session import PACKED, cut, estimated_bytes, fresh_path, release, scratch

IDENTITY = ["source_system", "source_id"]


def staged_table(raw: dict[str, DataFrame], table: str) -> DataFrame:
    """All sources of one target table, before any check against other tables."""
    parts = [stage(raw[e.name], e) for e in by_table(table)]
    return reduce(DataFrame.unionByName, parts)


def _reject(rows: DataFrame, condition: Column, reason: str, event: Column, keep_events: bool) -> DataFrame:
    """Exclude the rows not yet excluded for which ``condition`` holds."""
    hit = F.col("_reject").isNull() & condition
    events = F.concat("_events", F.array(event)) if keep_events else F.array(event)
    return rows.withColumns({
        "_events": F.when(hit, events).otherwise(F.col("_events")),
        "_reject": F.when(hit, F.lit(reason)).otherwise(F.col("_reject")),
    })


def require_parent(rows: DataFrame, parents: DataFrame, code: str, reason: str) -> DataFrame:
    """Exclude rows whose parent was not accepted. Their own cleaning is not reported."""
    on = {"source_system": "source_system", code: "source_id"}
    flagged = flag_known(rows, accepted(parents), on, "_known", deal=["source_id", SEQUENCE])
    event = ev.event(ev.EXCLUDED, reason, code, F.col(code))
    return _reject(flagged, ~F.col("_known"), reason, event, keep_events=False).drop("_known")


DEDUPE_KEY = ["source_system", "invoice_code", "payment_date", "amount", "_method", "_reference"]


def _printed_key() -> Column:
    shown = {"amount": F.col("amount_text"), "_method": F.coalesce("payment_method", F.lit("")),
             "_reference": F.coalesce("reference_number", F.lit(""))}
    return F.concat_ws("|", *[shown.get(k, F.col(k)).cast("string") for k in DEDUPE_KEY])


# Compressed bytes of the narrow copy of payments that are judged at a time.
SLICE_BYTES = 1 << 30


def check_payments(payments: DataFrame, invoices: DataFrame, slice_bytes: int = SLICE_BYTES, **sizes: int) -> DataFrame:
    """Orphans, then exact repeats, then the cap of the invoice total, in that order.

    A repeat is judged against every earlier payment, also one that the cap rejects. Both
    checks only look at rows that passed the ones before, and keep their cleaning events.
    They go over a narrow copy of the rows, which is written first: the checks look at it
    several times, and neither clean the extracts again nor carry the cleaning in their plans.
    A large copy is judged in slices, the invoices of one after those of another, so that
    the shuffle files of a slice are gone before the next; the copy goes after the last.
    The wide ones meet the verdicts once, with the columns only that are asked for later.
    """
    spark, judged_at = payments.sparkSession, fresh_path(payments.sparkSession)
    totals = cut(latest_by_key(accepted(invoices), IDENTITY, SEQUENCE, ["total_amount"]), packed=True)
    invoice = {"source_system": "source_system", "invoice_code": "source_id"}
    with scratch(spark):
        narrow = cut(accepted(payments).select(
            "source_system", "invoice_code", "payment_date", "amount", SEQUENCE,
            F.coalesce("payment_method", F.lit("")).alias("_method"), F.coalesce("reference_number", F.lit("")).alias("_reference")))
        release(spark)
        unplaced = payments.schema[SEQUENCE].nullable and not narrow.where(F.col(SEQUENCE).isNull()).isEmpty()
        slices = max(1, -(-estimated_bytes(narrow) // slice_bytes))
        for here in range(slices):
            mine = [frame if slices == 1 else frame.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) == here)
                    for frame, keys in ((narrow, list(invoice)), (totals, list(invoice.values())))]
            with scratch(spark):
                _verdicts(*mine, invoice, **sizes).write.mode("append").option("compression", PACKED).parquet(judged_at)
            release(spark)
    position = payments.schema[SEQUENCE].dataType
    verdicts = spark.read.schema(T.StructType([T.StructField("_source", T.StringType()), T.StructField("_row", position),
                                               T.StructField("_why", T.StringType())])).parquet(judged_at)
    if slices > 1:
        # A position that repeats may be an orphan's in several slices, and counts once.
        lost = verdicts.where(F.col("_why") == ev.ORPHAN_PAYMENT)
        if not lost.groupBy("_source", "_row").count().where("count > 1").isEmpty():
            verdicts = lost.distinct().unionByName(verdicts.where(F.col("_why") != ev.ORPHAN_PAYMENT))
        release(spark)

    # No two rows have one position, so none is hot. One without a position is only held against the invoices; where every
    # accepted payment has one, as in most loads, the plan holds the cleaning of the extracts once, and not three times.
    placed = payments.where(F.col(SEQUENCE).isNotNull()) if unplaced else payments
    judged = lookup(placed, verdicts, {"source_system": "_source", SEQUENCE: "_row"}, {"_why": "_why"}, hot_rows=None, deal=[SEQUENCE])
    if unplaced:
        lost = lookup(payments.where(F.col(SEQUENCE).isNull()), totals, invoice, {"_total": "total_amount"}, deal=["source_id"])
        why = F.when(F.col("_total").isNull(), F.lit(ev.ORPHAN_PAYMENT)).alias("_why")
        judged = judged.unionByName(lost.select(*payments.columns, why))
    orphan = ev.event(ev.EXCLUDED, ev.ORPHAN_PAYMENT, "invoice_code", F.col("invoice_code"))
    judged = _reject(judged, F.coalesce(F.col("_why") == ev.ORPHAN_PAYMENT, F.lit(False)), ev.ORPHAN_PAYMENT, orphan, keep_events=False)
    repeat = ev.event(ev.EXCLUDED, ev.DUPLICATE_PAYMENT, "dedupe_key", _printed_key())
    over = ev.event(ev.EXCLUDED, ev.OVER_CAP, "amount", F.col("amount_text"))
    for reason, event in ((ev.DUPLICATE_PAYMENT, repeat), (ev.OVER_CAP, over)):
        judged = _reject(judged, F.coalesce(F.col("_why") == reason, F.lit(False)), reason, event, keep_events=True)
    return judged.drop("_why")


def _verdicts(narrow: DataFrame, totals: DataFrame, invoice: dict[str, str], **sizes: int) -> DataFrame:
    """The positions of the excluded payments, and why."""
    # Accepted invoices always have a total, so its absence means there is no such invoice. No row or key comes or goes
    # with it, so the hot keys are looked for in the rows as they lie.
    billed = lookup(narrow, totals, invoice, {"_total": "total_amount"}, deal=[SEQUENCE])
    marked = cut(mark_first(billed, DEDUPE_KEY, SEQUENCE, "_first", None, HOT_ROWS, narrow).drop("payment_date", "_method", "_reference"))
    release(narrow.sparkSession)
    billed = marked.where(F.col("_total").isNotNull())
    capped = accept_within_cap(billed.where("_first").select("source_system", "invoice_code", SEQUENCE, "amount", "_total"),
                               ["source_system", "invoice_code"], SEQUENCE, "amount", "_total", "_fits", **sizes)
    row = [F.col("source_system").alias("_source"), F.col(SEQUENCE).alias("_row")]
    return (marked.where(F.col("_total").isNull()).select(*row, F.lit(ev.ORPHAN_PAYMENT).alias("_why")).distinct()
            .unionByName(billed.where(~F.col("_first")).select(*row, F.lit(ev.DUPLICATE_PAYMENT).alias("_why")))
            .unionByName(capped.where(~F.col("_fits")).select(*row, F.lit(ev.OVER_CAP).alias("_why"))))


PARENT = {"Invoices": "Customers", "InvoiceLines": "Invoices", "Payments": "Invoices"}
# What the checks of other tables read of a parent.
CHECKED = {"Customers": [*IDENTITY, "_reject"], "Invoices": [*IDENTITY, SEQUENCE, "total_amount", "_reject"]}


def conform(raw: dict[str, DataFrame], tables: tuple[str, ...] = TABLES,
            stage_to: str | None = None) -> dict[str, DataFrame]:
    """Staged rows of the wanted tables, with verdict and events.

    With ``stage_to`` each table, and each that it depends on, is written there and read back,
    so every extract is scanned once and a lost executor costs at most one table's work.
    Otherwise only the tables that others depend on are written, to the shared folder; of
    those that are not wanted themselves, just the columns that the checks read, so that their
    other values are not cleaned.
    """
    wanted = set(tables)
    for child in reversed(TABLES):
        if child in wanted and child in PARENT:
            wanted.add(PARENT[child])

    done: dict[str, DataFrame] = {}
    for table in [t for t in TABLES if t in wanted]:
        rows = staged_table(raw, table)
        # Children are held against the invoices that were accepted, so exclusions cascade.
        if table == "Invoices":
            rows = require_parent(rows, done["Customers"], "customer_code", ev.ORPHAN_INVOICE)
        elif table == "InvoiceLines":
            rows = require_parent(rows, done["Invoices"], "invoice_code", ev.ORPHAN_LINE)
        elif table == "Payments":
            rows = check_payments(rows, done["Invoices"])
        if stage_to is None and table not in tables:
            done[table] = cut(rows.select(*CHECKED[table]), packed=True)
        elif stage_to is None:
            done[table] = cut(rows, packed=True) if table in PARENT.values() else rows
        else:
            rows.write.mode("overwrite").parquet(f"{stage_to}/{table}")
            done[table] = rows.sparkSession.read.schema(rows.schema).parquet(f"{stage_to}/{table}")
        release(rows.sparkSession)
    return {t: rows for t, rows in done.items() if t in tables}


def quality_events(staged: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [ev.event_log(staged[t]) for t in TABLES if t in staged])


def written_events(staged: dict[str, DataFrame]) -> DataFrame:
    """The same log, written table by table: no plan holds the cleaning of all tables, and what the driver needs for a
    table's plan is free before the next."""
    logs = []
    for table in [t for t in TABLES if t in staged]:
        logs.append(cut(ev.event_log(staged[table]), packed=True))
        release(staged[table].sparkSession)
    return reduce(DataFrame.unionByName, logs)
