"""Data profiling: nulls, spacing, uniqueness, arithmetic, overlap.

Blank text, and the tokens that readers of raw files take for no value, count as missing
wherever a check speaks of missing values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cleaning import DAY_FIRST_DATE, ISO_DATE, clean_text
from ledgerloom.operators.joins import fits_broadcast, lookup
from ledgerloom.session import cut

TOLERANCE = "0.01"
# The texts that a type-inferring reader of CSV takes for no value.
BLANK_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                "NULL", "NaN", "None", "n/a", "nan", "null"]


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def missing(df: DataFrame, column: str) -> Column:
    """NULL, or a blank token in a text column."""
    value = F.col(column)
    return value.isNull() | value.isin(BLANK_TOKENS) if is_text(df.schema[column]) else value.isNull()


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f)]


def stripped(column: str) -> Column:
    """Python-style strip: every kind of white space at both ends."""
    edge = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
    return F.regexp_replace(F.col(column), edge, "")


def _per_column(counts: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row of counts, turned into a row per column."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(name)) for c in columns]
    return counts.select(*[c for c in counts.columns if c not in columns], F.explode(F.array(*pairs)).alias("p")).select(
        *[c for c in counts.columns if c not in columns], "p.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and share of the rows in percent. One scan."""
    counts = df.agg(F.count("*").alias("row_count"), *[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    share = F.round(F.col("null_count") / F.col("row_count") * 100, 1)
    return (_per_column(counts, df.columns, "null_count").filter("null_count > 0")
            .select("column", "null_count", share.alias("null_percent")))


# What texts can be read as, a bit each: a column is of the narrowest type that has all its bits.
BOOL, WHOLE, DECIMAL, DATE, TEXT = 1, 2, 4, 8, 16
BOOL_TEXT = "^([Tt]rue|TRUE|[Ff]alse|FALSE)$"
WHOLE_TEXT = "^ *[+-]?[0-9]+ *$"
DECIMAL_TEXT = "^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"


# What no date lacks. A text that does not parse costs the parser an exception, a hundred times as much as this test.
ISO_SHAPE = "^[+-]?[0-9]+-[0-9]+-[0-9]+$"
DAY_FIRST_SHAPE = "^[+-]?[0-9]+/[+-]?[0-9]+/[+-]?[0-9]+$"


def value_type(column: str) -> Column:
    """The bit of one value; whole numbers are decimals too, but not the other way round."""
    value = F.col(column)
    date = (F.when(value.rlike(ISO_SHAPE), F.try_to_date(value, ISO_DATE).isNotNull())
            .when(value.rlike(DAY_FIRST_SHAPE), F.try_to_date(value, DAY_FIRST_DATE).isNotNull()).otherwise(False))
    return (F.when(value.rlike(WHOLE_TEXT), WHOLE).when(value.rlike(DECIMAL_TEXT), DECIMAL).when(value.rlike(BOOL_TEXT), BOOL)
            .when(date, DATE).otherwise(TEXT))


def type_name(bits: Column) -> Column:
    """The join of the bits in the lattice: nothing below all, text above all, whole below decimal."""
    named = {0: "nothing", BOOL: "bool", WHOLE: "whole", DECIMAL: "decimal", WHOLE | DECIMAL: "decimal", DATE: "date"}
    found = F.lit("text")
    for value, name in named.items():
        found = F.when(bits == value, name).otherwise(found)
    return found


def column_types(df: DataFrame) -> DataFrame:
    """``column, type, known, missing``: what type the values of each text column have together, how many there are, and how many
    are missing. One scan; the bits of tasks are merged by OR."""
    columns = text_columns(df)
    counts = df.agg(F.count("*").alias("row_count"), *[
        F.struct(F.coalesce(F.bit_or(F.when(~missing(df, c), value_type(c))), F.lit(0)).alias("bits"),
                 F.count_if(missing(df, c)).alias("missing")).alias(c) for c in columns])
    found = _per_column(counts, columns, "found")
    return found.select("column", type_name(F.col("found.bits")).alias("type"),
                        (F.col("row_count") - F.col("found.missing")).alias("known"), F.col("found.missing").alias("missing"))


def repeated_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Later occurrences of a key (or of a whole row): rows minus distinct keys. Missing
    values equal each other. Counts are combined map-side before the shuffle. Of whole rows
    only a hash is shuffled, and only rows whose hash comes again are compared: the hashes that
    do are written first, so their number is known, and without any no row is read again."""
    if keys is not None:
        groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
        return groups.agg(F.sum("n").alias("row_count"), F.sum(F.col("n") - 1).alias("repeated_rows"))
    hashed = F.xxhash64(*df.columns)
    often = cut(df.select(hashed.alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    total = df.agg(F.nullif(F.count("*"), F.lit(0)).alias("row_count"))
    if often.isEmpty():
        return total.withColumn("repeated_rows", F.lit(0).cast("bigint"))
    # Beyond a broadcast, all rows are dealt out by value, rather than by hash and then by value.
    again = df.join(F.broadcast(often), hashed == F.col("hash"), "left_semi") if fits_broadcast(often) else df
    repeats = again.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_rows"))
    return total.crossJoin(repeats)  # a row each


def whitespace_profile(df: DataFrame) -> DataFrame:
    """Rows per text column whose value starts or ends with white space. One scan."""
    columns = text_columns(df)
    counts = df.agg(*[F.count_if(stripped(c) != F.col(c)).alias(c) for c in columns])
    return _per_column(counts, columns, "rows_with_spaces").filter("rows_with_spaces > 0")


def uneven_spacing(df: DataFrame, column: str) -> DataFrame:
    """Rows with white space at an end, or two spaces in a row."""
    return df.filter((stripped(column) != F.col(column)) | F.contains(F.col(column), F.lit("  ")))


def rows_with_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.filter(reduce(Column.__or__, [missing(df, c) for c in columns or df.columns]))


def frequent_keys(df: DataFrame, key: str, count: str) -> DataFrame:
    """Keys on more than one row."""
    return df.filter(~missing(df, key)).groupBy(key).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def overpaid(payments: DataFrame, invoices: DataFrame, key: str, amount: str, total: str) -> DataFrame:
    """Keys whose payments add up to more than the invoice total; unknown totals are not judged.
    Payments are summed before the join."""
    paid = payments.filter(~missing(payments, key)).groupBy(key).agg(F.sum(amount).alias("total_paid"))
    both = lookup(paid, invoices.select(F.col(key), F.col(total)), {key: key}, {"invoice_total": total})
    excess = F.round(F.col("total_paid") - F.col("invoice_total"), 2)
    return both.withColumn("excess", excess).filter(F.col("excess") > F.lit(TOLERANCE).cast("decimal(3,2)"))


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Detail rows of the flagged keys."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")


def members_of_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once. The counts are taken map-side first; only
    repeated keys meet the rows again, so no group is gathered in one task. Missing values
    equal each other."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    repeated = (df.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(F.count("*").alias("_n"))
                .filter("_n > 1").drop("_n"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return df.join(repeated, same, "left_semi")


def unequal_sums(df: DataFrame, parts: list[str], total: str) -> DataFrame:
    """Rows whose parts differ from the total by more than the tolerance."""
    gap = reduce(Column.__add__, [F.col(p) for p in parts]) - F.col(total)
    return df.filter(F.abs(gap) > F.lit(TOLERANCE).cast("decimal(3,2)"))


def frequency_where(df: DataFrame, condition: Column, column: str) -> DataFrame:
    return df.filter(condition).groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)


def unexpected_missing(df: DataFrame, column: str, method: str, allowed: str) -> DataFrame:
    """Rows that lack ``column`` although only the ``allowed`` method may."""
    return df.filter(missing(df, column) & (clean_text(F.col(method)) != allowed))


def _codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct trimmed values; missing ones are dropped."""
    return df.filter(~missing(df, column)).select(stripped(column).alias("code")).distinct()


def shared_codes(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    return _codes(left, left_column).intersect(_codes(right, right_column))


def rows_with_codes(rows: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    return rows.join(codes, stripped(column) == F.col("code"), "left_semi")


def code_overlap(sets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct codes per set, and codes shared by each pair. Every set is scanned once: the
    sets that hold a code are collected per code, which is at most one entry per set."""
    names = sorted(sets)
    tagged = reduce(DataFrame.unionByName,
                    [_codes(df, column).withColumn("_set", F.lit(name)) for name, (df, column) in sets.items()])
    held = tagged.groupBy("code").agg(F.collect_set("_set").alias("_sets"))

    def holds(*wanted: str) -> Column:
        return F.count_if(reduce(Column.__and__, [F.array_contains("_sets", w) for w in wanted]))

    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    measures = {a: (a, a) for a in names} | {f"{a}&{b}": (a, b) for a, b in pairs}
    counts = held.agg(*[holds(*set(pair)).alias(label) for label, pair in measures.items()])
    return _per_column(counts, list(measures), "codes").withColumnRenamed("column", "sets")


def missing_id_count(df: DataFrame, id_column: str) -> DataFrame:
    """How many rows have no source id."""
    return df.agg(F.count_if(clean_text(F.col(id_column)) == "").alias("affected_rows"))


def invalid_dates_count(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Rows per date column that are missing or do not parse as they stand. One scan for all columns."""
    counts = df.agg(*[F.count_if(F.try_to_date(F.col(c), p).isNull()).alias(c) for c, p in patterns.items()])
    return _per_column(counts, list(patterns), "affected_rows")
