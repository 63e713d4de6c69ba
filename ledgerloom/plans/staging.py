"""One source extract to its staged rows: cleaned values, quality events and a verdict.

A staged row has the target columns plus ``table, source_system, source_id``, its position
``_seq``, the reason ``_reject`` it was excluded for (NULL when accepted) and ``_events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as c
from ledgerloom.functions import events as ev
from ledgerloom.sources.extracts import Extract, Field
from ledgerloom.sources.files import SEQUENCE
from ledgerloom.sources.schemas import STAR, column_types
from ledgerloom.session import spread

# Columns that later checks need and the target table does not have.
STAGED_ONLY = {"InvoiceLines": {"invoice_code": "string"}, "Payments": {"amount_text": "string"}}
# Keys that are resolved when the tables are published.
RESOLVED = ("customer_id", "supplier_id", "product_id", "invoice_id", "line_id", "payment_id")


def _clean(source: str) -> Column:
    return F.col(f"_clean_{source}")


def _apply(field: Field, extract: Extract) -> c.Cleaned:
    column = F.col(field.source) if field.source else None
    text = _clean(field.source) if field.source else None
    match field.rule:
        case "id":
            return c.Cleaned(_clean(extract.id_column))
        case "required":
            return c.required_text(column, field.target, text)
        case "optional":
            return c.optional_text(column, field.target, text)
        case "email":
            return c.email(column, field.target, text)
        case "date":
            return c.date(column, field.target, field.extra, True, text)
        case "optional_date":
            return c.date(column, field.target, field.extra, False, text)
        case "decimal":
            return c.decimal(column, field.target, extract.source_system, text)
        case "decimal_text":
            digits = c.number_text(text, extract.source_system)
            return c.Cleaned(F.when(digits.try_cast(c.STAGING_DECIMAL).isNull(), F.lit("0")).otherwise(digits))
        case "flag":
            return c.flag(column, text)
        case "key":
            return c.Cleaned(text)
        case "code":
            return c.code(column, text)
        case "default":
            return c.with_default(column, field.extra, text)
        case "constant":
            return c.Cleaned(F.lit(field.extra))
        case "null":
            return c.Cleaned(F.lit(None))
        case "first_name":
            return c.Cleaned(c.first_name(c.required_text(column, field.target, text).value))
        case "last_name":
            return c.Cleaned(c.last_name(c.required_text(column, field.target, text).value))
        case "difference":
            minuend = c.decimal(column, field.source, extract.source_system, text).value
            other = F.col(field.extra)
            subtrahend = c.decimal(other, field.extra, extract.source_system, _clean(field.extra)).value
            return c.Cleaned((minuend - subtrahend).cast(c.STAGING_DECIMAL))
    raise ValueError(f"unknown rule {field.rule}")


def staged_types(table: str) -> dict[str, str]:
    """Columns of a staged row; money keeps its full scale until it is published."""
    types = {n: t.rstrip("!") for n, t in column_types(STAR[table]).items() if n not in RESOLVED}
    types = {n: c.STAGING_DECIMAL if t.startswith("decimal") else t for n, t in types.items()}
    return {**types, **STAGED_ONLY.get(table, {})}


def stage(raw: DataFrame, extract: Extract) -> DataFrame:
    """Clean every used column once, then derive values and events from raw and clean text."""
    used = sorted({extract.id_column, *(f.source for f in extract.fields if f.source),
                   *(f.extra for f in extract.fields if f.rule == "difference")})
    cleaned = spread(raw).select(*used, SEQUENCE, *[c.clean_text(F.col(u)).alias(f"_clean_{u}") for u in used])

    done = {f.target: _apply(f, extract) for f in extract.fields}
    no_id = _clean(extract.id_column) == ""
    found = ev.event_list([d.events for d in done.values() if d.events is not None])
    missing = F.array(ev.event(ev.EXCLUDED, ev.MISSING_ID, extract.id_column))
    return cleaned.select(
        F.lit(extract.table).alias("table"),
        F.lit(extract.source_system).alias("source_system"),
        F.when(no_id, c.raw_text(F.col(extract.id_column))).otherwise(_clean(extract.id_column)).alias("source_id"),
        *[done[name].value.cast(kind).alias(name) for name, kind in staged_types(extract.table).items()],
        F.col(SEQUENCE),
        F.when(no_id, F.lit(ev.MISSING_ID)).alias("_reject"),
        F.when(no_id, missing).otherwise(found).alias("_events"),
    )


def accepted(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("_reject").isNull())
