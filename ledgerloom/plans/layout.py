"""Physical layout of the tables, and the retention of history.

The layouts stand in for indexes: month folders for date ranges, rows sorted within files
so that their statistics prune, and buckets for joins on the order id.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.manifest import StoredTable
from ledgerloom.sources.schemas import SHOP, STAR, shop_schema, star_schema
from ledgerloom.sources.storage import Folder

FOLDER_ROWS = 20_000_000
ARCHIVE = "archive"


def create_tables(spark: SparkSession, database: str, model: str = "star") -> None:
    """Create or reset the target tables, parents before children."""
    names, schema = (STAR, star_schema) if model == "star" else (SHOP, shop_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in reversed(names):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    for name in names:
        spark.sql(f"CREATE TABLE {database}.{name} ({schema(name).toDDL()}) USING parquet")


def analyze(spark: SparkSession, tables: list[str]) -> None:
    """Refresh the statistics the optimizer uses, after a bulk load."""
    for name in tables:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def catalogue(spark: SparkSession, database: str, paths: dict[str, str]) -> list[str]:
    """Name Parquet folders as tables of a database, where they are, and gather their statistics in one scan each."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, path in paths.items():
        names.append(f"{database}.{name}")
        spark.sql(f"CREATE TABLE {names[-1]} USING parquet LOCATION '{path}'")
    analyze(spark, names)
    return names


def _unsigned_zero(text: str) -> float:
    return float(text) + 0.0  # which of two zeros is the least is chance


def column_statistics(spark: SparkSession, tables: list[str]) -> DataFrame:
    """``table, column, rows, nulls, distinct, lowest, highest`` of the numeric columns as the optimizer knows them, from the
    catalogue alone. Distinct counts are estimates; what was never analyzed is null."""
    found = []
    for name in tables:
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        rows = re.search(r"(\d+) rows", described.get("Statistics", ""))
        for f in spark.table(name).schema.fields:
            if isinstance(f.dataType, T.NumericType):
                known = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} `{f.name}`").collect()}
                values = [None if known.get(k) in (None, "NULL") else known[k] for k in ("num_nulls", "distinct_count", "min", "max")]
                nulls, distinct, lowest, highest = (v if v is None else kind(v) for kind, v in zip((int, int, _unsigned_zero, _unsigned_zero), values))
                found.append((name.rpartition(".")[2], f.name, int(rows[1]) if rows else None, nulls, distinct, lowest, highest))
    return spark.createDataFrame(found, "table string, column string, rows long, nulls long, distinct long, lowest double, highest double")


def write_by_month(df: DataFrame, path: str, moment: str, mode: str = "overwrite") -> None:
    """One folder per month, rows sorted by time in each file. A month is spread over tasks
    by range, so a busy month is written by many of them."""
    dated = df.withColumns({"year": F.year(moment), "month": F.month(moment)})
    (dated.repartitionByRange("year", "month", moment).sortWithinPartitions("year", "month", moment)
     .write.mode(mode).option("maxRecordsPerFile", FOLDER_ROWS).partitionBy("year", "month").parquet(path))


def write_sorted(df: DataFrame, path: str, columns: list[str]) -> None:
    """Range-sorted files: a filter on the leading column skips most of them."""
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A catalogued table that joins on ``key`` without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def split_by_age(df: DataFrame, moment: str, cutoff: str) -> DataFrame:
    """Label each row ``archive`` when it is older than the cutoff, else ``active``."""
    old = F.col(moment) < F.lit(cutoff).cast("timestamp_ntz")
    return df.withColumn("tier", F.when(old, F.lit("archive")).otherwise(F.lit("active")))


def months(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The month folders of a table, from the folder names alone."""
    folder, found = Folder(spark, path), []
    for year in folder.folders():
        if year.startswith("year="):
            found += [(int(year[5:]), int(m[6:])) for m in folder.folders(year) if m.startswith("month=")]
    return sorted(found)


def archive_months(spark: SparkSession, active: str, archive: str, cutoff: date) -> list[tuple[int, int]]:
    """Move the months that end by the cutoff to the archive. Folders are renamed, no data
    is rewritten, and a run that stops half-way is finished by the next one."""
    old = [m for m in months(spark, active) if m < (cutoff.year, cutoff.month)]
    for year, month in old:
        name = f"year={year}/month={month}"
        Folder(spark, active).move(name, Folder(spark, archive), name)
    return old


def month_part(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM")


def archive_listed(table: StoredTable, moment: str, archive: str, cutoff: date) -> list[str]:
    """Move the months that end by the cutoff to the archive: copied by one job, switched in one step, and only then deleted
    where they were. A run that stops in between leaves a table that reads as before or after, and the next one cleans up."""
    moved = table.move([n for n in table.manifest().names() if n < f"{cutoff:%Y-%m}"], ARCHIVE, archive, month_part(moment))
    table.remove_unlisted(archive)
    return moved


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by month, without its folder columns."""
    full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return spark.read.schema(full).parquet(path)
