from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as c


def run(spark, cleaned_of, values, extra=None):
    """[(value, action, new_value)] of a rule over raw values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    cleaned = cleaned_of(F.col("raw"))
    events = cleaned.events if cleaned.events is not None else F.array().cast("array<struct<action:string,new_value:string>>")
    rows = df.select("i", cleaned.value.alias("v"), F.get(events, F.lit(0)).alias("e")).orderBy("i").collect()
    return [(r.v, r.e.action if r.e else None, r.e.new_value if r.e else None) for r in rows]


def test_clean_text_takes_every_kind_of_space(spark):
    raw = " \ta  b　\u001c c\n"
    others = "x\u0085  y\x0bz"
    df = spark.createDataFrame([(raw,), (others,), (None,)], "t string")
    assert [r[0] for r in df.select(c.clean_text(F.col("t"))).collect()] == ["a b c", "x y z", ""]


def test_required_text(spark):
    got = run(spark, lambda x: c.required_text(x, "f"), ["", "   ", "ok", " ok"])
    assert got == [("NO DISPONIBLE", "default_applied", "NO DISPONIBLE")] * 2 + [("ok", None, None), ("ok", "cleaned", "ok")]


def test_optional_text_is_silent_only_for_empty(spark):
    got = run(spark, lambda x: c.optional_text(x, "f"), ["", "   ", " x", None])
    assert got == [(None, None, None), (None, "cleaned", ""), ("x", "cleaned", "x"), (None, None, None)]


def test_email(spark):
    got = run(spark, c.email, [" A@B.COM ", "", "\t"])
    default = ("no_disponible@placeholder.com", "default_applied", "no_disponible@placeholder.com")
    assert got == [("a@b.com", None, None), default, default]


def test_dates(spark):
    sentinel = date(1900, 1, 1)
    values = ["31/02/2024", "", "05/01/2024", "5/1/2024", "2024-01-05"]
    required = run(spark, lambda x: c.date(x, "f", c.DAY_FIRST_DATE, True), values)
    assert [r[0] for r in required] == [sentinel, sentinel, date(2024, 1, 5), date(2024, 1, 5), sentinel]
    assert [r[1] for r in required] == ["default_applied", "default_applied", None, None, "default_applied"]
    optional = run(spark, lambda x: c.date(x, "f", c.DAY_FIRST_DATE, False), values[:3])
    assert optional == [(None, "cleaned", ""), (None, None, None), (date(2024, 1, 5), None, None)]
    iso = run(spark, lambda x: c.date(x, "f", c.ISO_DATE, False), ["2024-01-05", "2024-13-01"])
    assert [r[0] for r in iso] == [date(2024, 1, 5), None]


@pytest.mark.parametrize(("source", "values", "numbers", "actions"), [
    ("SOURCE_B", ["1.450,00", "1.450", "0.00", "", "abc", "-3,5"], ["1450.00", "1.450", "0", "0", "0", "-3.5"],
     [None, None, None, None, "default_applied", None]),
    ("SOURCE_A", ["$1,299.50", "1,299.50", "$", "NaN", " 7 "], ["1299.50", "1299.50", "0", "0", "7"],
     [None, None, None, "default_applied", None]),
])
def test_decimals(spark, source, values, numbers, actions):
    got = run(spark, lambda x: c.decimal(x, "f", source), values)
    assert [r[0] for r in got] == [Decimal(n) for n in numbers]
    assert [r[1] for r in got] == actions


def test_profile_decimal_always_drops_dots(spark):
    df = spark.createDataFrame([("1.450,00",), ("12.50",), ("x",)], "t string")
    got = [r[0] for r in df.select(c.profile_decimal(F.col("t"))).collect()]
    assert got == [Decimal("1450"), Decimal("1250"), None]


def test_flags(spark):
    got = run(spark, c.flag, ["1", "Si", "ACTIVO", "sí", "0", ""])
    assert [r[0] for r in got] == [True, True, True, False, False, False]


def test_names_split_at_the_first_space(spark):
    df = spark.createDataFrame([("Ana Maria Lopez",), ("Ana",)], "n string")
    got = [tuple(r) for r in df.select(c.first_name(F.col("n")), c.last_name(F.col("n"))).collect()]
    assert got == [("Ana", "Maria Lopez"), ("Ana", "NO DISPONIBLE")]


def test_email_domain(spark):
    df = spark.createDataFrame([("u@Gmail.com",), ("noat",), ("a@b@C",)], "e string")
    assert [r[0] for r in df.select(c.email_domain(F.col("e"))).collect()] == ["gmail.com", "noat", "b@c"]


def test_defaults_and_codes(spark):
    assert [r[0] for r in run(spark, lambda x: c.with_default(x, "PENDING"), [" ", " PAID "])] == ["PENDING", "PAID"]
    assert [r[0] for r in run(spark, c.code, [" ", " a b "])] == [None, "a b"]
