"""Cleaning rules as Column expressions.

Each rule that can be audited returns ``Cleaned(value, events)``; the events are an array of
one, NULL on rows the rule left alone, and ``None`` when the rule never reports anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import events as ev

# Fixed values.
TEXT_DEFAULT = "NO DISPONIBLE"
EMAIL_DEFAULT = "no_disponible@placeholder.com"
DATE_DEFAULT = "1900-01-01"
TRUE_TOKENS = ["1", "true", "t", "yes", "y", "si", "activo"]

ISO_DATE = "yyyy-MM-dd"
DAY_FIRST_DATE = "d/M/yyyy"  # takes one- and two-digit days and months
# 25 digits before the point and 12 after it, further ones being rounded. One digit less than
# Spark has, so that sums and differences of two amounts are exact.
STAGING_DECIMAL = "decimal(37,12)"
_PLAIN_NUMBER = r"^[+-]?\d+(\.\d*)?$"
COMMA_SOURCES = {"SOURCE_B"}

# Unicode white space plus the four ASCII separators that Java's class leaves out.
_SPACES = r"(?U)[\s\x1c-\x1f]+"


@dataclass(frozen=True)
class Cleaned:
    value: Column
    events: Column | None = None


def raw_text(column: Column) -> Column:
    """The source value as text; a missing one is the empty string."""
    return F.coalesce(column, F.lit(""))


def clean_text(column: Column) -> Column:
    return F.trim(F.regexp_replace(raw_text(column), _SPACES, " "))


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def required_text(column: Column, field: str, text: Column | None = None) -> Cleaned:
    text = clean_text(column) if text is None else text
    raw = raw_text(column)
    return Cleaned(
        F.when(text == "", F.lit(TEXT_DEFAULT)).otherwise(text),
        ev.reported((text == "", ev.event(ev.DEFAULTED, ev.EMPTY_TEXT, field, raw, TEXT_DEFAULT)),
                    (text != raw, ev.event(ev.CLEANED, ev.WHITESPACE, field, raw, text))),
    )


def optional_text(column: Column, field: str, text: Column | None = None) -> Cleaned:
    """A blank of spaces becomes NULL with an event; an empty value becomes NULL silently."""
    text = clean_text(column) if text is None else text
    raw = raw_text(column)
    return Cleaned(
        null_if_empty(text),
        ev.reported(((text != raw) & (raw != ""), ev.event(ev.CLEANED, ev.WHITESPACE, field, raw, text))),
    )


def email(column: Column, field: str = "email", text: Column | None = None) -> Cleaned:
    text = F.lower(clean_text(column) if text is None else text)
    return Cleaned(
        F.when(text == "", F.lit(EMAIL_DEFAULT)).otherwise(text),
        ev.reported((text == "", ev.event(ev.DEFAULTED, ev.EMPTY_EMAIL, field, raw_text(column), EMAIL_DEFAULT))),
    )


def date(column: Column, field: str, pattern: str, required: bool = True, text: Column | None = None) -> Cleaned:
    text = clean_text(column) if text is None else text
    raw = raw_text(column)
    parsed = F.try_to_date(text, pattern)
    if not required:
        return Cleaned(
            parsed,
            ev.reported(((text != "") & parsed.isNull(), ev.event(ev.CLEANED, ev.BAD_OPTIONAL_DATE, field, raw, ""))),
        )
    return Cleaned(
        F.coalesce(parsed, F.lit(DATE_DEFAULT).cast("date")),
        ev.reported((text == "", ev.event(ev.DEFAULTED, ev.EMPTY_DATE, field, raw, DATE_DEFAULT)),
                    (parsed.isNull(), ev.event(ev.DEFAULTED, ev.BAD_DATE, field, raw, DATE_DEFAULT))),
    )


def number_text(text: Column, source: str) -> Column:
    """Digits with a decimal point, following the source's own number format."""
    if source in COMMA_SOURCES:
        point = F.translate(F.replace(text, F.lit("."), F.lit("")), ",", ".")
        text = F.when(F.contains(text, F.lit(",")), point).otherwise(text)
    return F.trim(F.translate(text, "$,", ""))


def decimal(column: Column, field: str, source: str, text: Column | None = None) -> Cleaned:
    """An empty amount is a silent zero; one that does not parse is a zero with an event, and
    so is a number that is too large, with an event of its own."""
    digits = number_text(clean_text(column) if text is None else text, source)
    parsed = digits.try_cast(STAGING_DECIMAL)
    return Cleaned(
        F.coalesce(parsed, F.lit(0).cast(STAGING_DECIMAL)),
        ev.reported((parsed.isNull() & digits.rlike(_PLAIN_NUMBER),
                     ev.event(ev.DEFAULTED, ev.LARGE_DECIMAL, field, raw_text(column), "0")),
                    ((digits != "") & parsed.isNull(),
                     ev.event(ev.DEFAULTED, ev.BAD_DECIMAL, field, raw_text(column), "0"))),
    )


def profile_decimal(column: Column) -> Column:
    """The profiling variant: dots are always thousands marks and a bad value is NULL."""
    digits = F.translate(F.replace(column, F.lit("."), F.lit("")), ",", ".")
    return digits.try_cast(STAGING_DECIMAL)


def flag(column: Column, text: Column | None = None) -> Cleaned:
    text = clean_text(column) if text is None else text
    return Cleaned(F.lower(text).isin(TRUE_TOKENS))


def code(column: Column, text: Column | None = None) -> Cleaned:
    return Cleaned(null_if_empty(clean_text(column) if text is None else text))


def with_default(column: Column, default: str, text: Column | None = None) -> Cleaned:
    text = clean_text(column) if text is None else text
    return Cleaned(F.when(text == "", F.lit(default)).otherwise(text))


def first_name(full_name: Column) -> Column:
    return F.element_at(F.split(full_name, " ", 2), 1)


def last_name(full_name: Column) -> Column:
    return F.coalesce(F.get(F.split(full_name, " ", 2), F.lit(1)), F.lit(TEXT_DEFAULT))


def email_domain(address: Column) -> Column:
    """The part after the first ``@``, or the whole text without one."""
    return F.lower(F.substr(address, F.locate("@", address) + 1))
