"""The cleaning rules, each over a whole text or number column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as c
from ledgerloom.session import spread
from ledgerloom.sources import tables
from workload import expected as sql
from workload.registry import query


def _audited(rows: DataFrame, keys: list[str], cleaned: c.Cleaned) -> DataFrame:
    """The cleaned value, and the event where there was one."""
    event = F.get(cleaned.events, F.lit(0))
    return rows.select(*keys, cleaned.value.alias("value"), event.alias("e")).select(
        *keys, "value", "e.action", "e.reason", "e.new_value")


def _audited_sql(keys: str, value: str, event: str, source: str) -> str:
    return (f"SELECT {keys}, value, e.action AS action, e.reason AS reason, e.new_value AS new_value "
            f"FROM (SELECT {keys}, {value} AS value, {event} AS e FROM {source})")


def _rule(rule: str, target: str, source: str, extra: str | None = None, system: str = "SOURCE_A") -> tuple[str, str]:
    """Value and event SQL of a rule."""
    from ledgerloom.sources.extracts import Extract, Field
    extract = Extract(system, "", "", (source,), source, ())
    return sql.rule_sql(Field(target, rule, source, extra), extract)


@query("clean_text", f"SELECT doc_id, {sql.clean('text')} AS text FROM documents")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return spread(tables.table(spark, folder, "documents")).select("doc_id", c.clean_text(F.col("text")).alias("text"))


# Every seventh text is empty and every eleventh is white space only.
TURNS = """
SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 0 THEN '' WHEN (conv_id + turn) % 11 = 0 THEN ' ' || chr(9)
                           ELSE text END AS text FROM {conversations}"""


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TURNS, conversations=tables.table(spark, folder, "conversations"))


TURNS_SQL = f"({TURNS.format(conversations='conversations')})"


@query("required_text", _audited_sql("conv_id, turn", *_rule("required", "text", "text"), TURNS_SQL))
def required_text(spark: SparkSession, folder: str) -> DataFrame:
    return _audited(_turns(spark, folder), ["conv_id", "turn"], c.required_text(F.col("text"), "text"))


@query("optional_text", _audited_sql("conv_id, turn", *_rule("optional", "text", "text"), TURNS_SQL))
def optional_text(spark: SparkSession, folder: str) -> DataFrame:
    return _audited(_turns(spark, folder), ["conv_id", "turn"], c.optional_text(F.col("text"), "text"))


ADDRESSES = """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 10 = 0 THEN chr(160) || ' '
                       ELSE '  ' || c_name || '@' || c_mktsegment || '.Com ' END AS email FROM {customer}"""


@query("email_norm", _audited_sql("c_custkey", *_rule("email", "email", "email"),
                                  f"({ADDRESSES.format(customer='customer')})"))
def email_norm(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(ADDRESSES, customer=tables.table(spark, folder, "customer"))
    return _audited(rows, ["c_custkey"], c.email(F.col("email")))


ACCOUNTS = """
SELECT c_custkey, cast(cast(c_acctbal AS decimal(12,2)) AS string) AS plain FROM {customer}"""
COMMAS = f"""
SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN 'n/a' WHEN c_custkey % 5 = 0 THEN plain
                       WHEN c_custkey % 19 = 0 THEN '12.345.678.901.234.567.890,5' WHEN c_custkey % 23 = 0 THEN '0,000123456789'
                       WHEN c_custkey % 29 = 0 THEN '1' || repeat('0', 30) || ',1'
                       ELSE '1.' || replace(plain, '.', ',') END AS amount FROM ({ACCOUNTS})"""
SIGNS = f"""
SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN '$' WHEN c_custkey % 17 = 0 THEN '$x' WHEN c_custkey % 5 = 0 THEN plain
                       ELSE ' $ 2,' || plain END AS amount FROM ({ACCOUNTS})"""


@query("decimal_comma", _audited_sql("c_custkey", *_rule("decimal", "amount", "amount", system="SOURCE_B"),
                                     f"({COMMAS.format(customer='customer')})"))
def decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(COMMAS, customer=tables.table(spark, folder, "customer"))
    return _audited(rows, ["c_custkey"], c.decimal(F.col("amount"), "amount", "SOURCE_B"))


@query("decimal_currency", _audited_sql("c_custkey", *_rule("decimal", "amount", "amount", system="SOURCE_C"),
                                        f"({SIGNS.format(customer='customer')})"))
def decimal_currency(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(SIGNS, customer=tables.table(spark, folder, "customer"))
    return _audited(rows, ["c_custkey"], c.decimal(F.col("amount"), "amount", "SOURCE_C"))


@query("decimal_profile", f"""
SELECT c_custkey, TRY_CAST(replace(replace(amount, '.', ''), ',', '.') AS DECIMAL(37,12)) AS value
FROM ({COMMAS.format(customer='customer')})""")
def decimal_profile(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(COMMAS, customer=tables.table(spark, folder, "customer"))
    return rows.select("c_custkey", c.profile_decimal(F.col("amount")).alias("value"))


DATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN '31/02/2024'
                        WHEN o_orderkey % 17 = 0 THEN '2024-01-05'
                        ELSE extract(day FROM o_orderdate) || '/' || extract(month FROM o_orderdate) || '/' ||
                             extract(year FROM o_orderdate) END AS day FROM {orders}"""
DATES_SQL = f"({DATES.format(orders='orders')})"


def _dates(spark: SparkSession, folder: str, required: bool) -> DataFrame:
    rows = spark.sql(DATES, orders=tables.table(spark, folder, "orders"))
    return _audited(rows, ["o_orderkey"], c.date(F.col("day"), "day", c.DAY_FIRST_DATE, required))


@query("date_dmy", _audited_sql("o_orderkey", *_rule("date", "day", "day", c.DAY_FIRST_DATE), DATES_SQL))
def date_dmy(spark: SparkSession, folder: str) -> DataFrame:
    return _dates(spark, folder, True)


@query("date_optional", _audited_sql("o_orderkey", *_rule("optional_date", "day", "day", c.DAY_FIRST_DATE), DATES_SQL))
def date_optional(spark: SparkSession, folder: str) -> DataFrame:
    return _dates(spark, folder, False)


def _by_segment(column: str, choices: dict[str, str], other: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in choices.items())
    return f"CASE {column} {cases} ELSE {other} END"


FLAGS = f"""
SELECT c_custkey, {_by_segment('c_mktsegment', {'HOUSEHOLD': "' Si '", 'MACHINERY': "'ACTIVO'", 'BUILDING': "'s' || chr(237)",
                                                'FURNITURE': "'0'"}, "'TRUE'")} AS flag FROM {{customer}}"""


@query("bool_parse", f"SELECT c_custkey, {_rule('flag', 'flag', 'flag')[0]} AS value FROM ({FLAGS.format(customer='customer')})")
def bool_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(FLAGS, customer=tables.table(spark, folder, "customer"))
    return rows.select("c_custkey", c.flag(F.col("flag")).value.alias("value"))


NAMES = "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE p_name || ' ' || p_brand END AS name FROM {part}"


@query("split_name", f"""
SELECT p_partkey, {_rule('first_name', 'name', 'name')[0]} AS first_name, {_rule('last_name', 'name', 'name')[0]} AS last_name
FROM ({NAMES.format(part='part')})""")
def split_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(NAMES, part=tables.table(spark, folder, "part"))
    full = c.required_text(F.col("name"), "name").value
    return rows.select("p_partkey", c.first_name(full).alias("first_name"), c.last_name(full).alias("last_name"))


STATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE ' ' || o_orderstatus END AS state FROM {orders}"""


@query("status_default", f"""
SELECT o_orderkey, {_rule('default', 'status', 'state', 'PENDING')[0]} AS status, {_rule('code', 'code', 'state')[0]} AS code
FROM ({STATES.format(orders='orders')})""")
def status_default(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.sql(STATES, orders=tables.table(spark, folder, "orders"))
    state: Column = F.col("state")
    return rows.select("o_orderkey", c.with_default(state, "PENDING").value.alias("status"), c.code(state).value.alias("code"))
