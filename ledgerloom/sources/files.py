"""Reading the source extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.extracts import ENCODINGS, EXTRACTS, Extract
from ledgerloom.sources.records import header, parsed, read_records

SEQUENCE = "_seq"


def found_files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Size in bytes of the files of the contract that are in ``folder``, on any file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sizes = {}
    for extract in EXTRACTS:
        path = hadoop.Path(f"{folder}/{extract.path}")
        files = path.getFileSystem(conf)
        if files.exists(path):
            sizes[extract.path] = files.getContentSummary(path).getLength()
    return sizes


def validate_files(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that lacks any file of the contract, before one of them is read."""
    there = found_files(spark, folder)
    absent = [e.path for e in EXTRACTS if e.path not in there]
    if absent:
        raise FileNotFoundError(f"{folder} lacks {len(absent)} of {len(EXTRACTS)} extracts: {', '.join(absent)}")


def file_position() -> Column:
    """Sorts rows as they stand in their files. Row numbers grow within a split and splits
    by their offset, so it does not matter which task read which split."""
    return F.struct(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"))


def repaired(text: Column) -> Column:
    """Text that was read as Latin-1 though its bytes are valid UTF-8; other text stays."""
    as_utf8 = F.encode(text, "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(text)


# Without these, Spark trims values as it writes and escapes quotes in a way of its own.
EXACT_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False}


def write_csv(rows: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """CSV that keeps every value as it is, edge spaces, quotes and line breaks too."""
    rows.write.mode("overwrite").options(**EXACT_CSV, encoding=encoding).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_csv`` wrote, line breaks inside quotes too."""
    return parsed(read_records(spark, path), schema).select("values.*")


def write_extract(rows: DataFrame, folder: str, extract: Extract) -> None:
    write_csv(rows.select(*extract.columns), f"{folder}/{extract.path}", ENCODINGS[extract.source_system])


def read_extract(spark: SparkSession, folder: str, extract: Extract, strict_encoding: bool = False,
                 line_breaks: bool = False) -> DataFrame:
    """All columns as text, an empty value as the empty string, with the position in file.

    Columns are found by the names in the header, in any order; columns beyond the contract
    are left out, and a missing one is an error. So is a row with too few or too many values.
    ``line_breaks`` lets quoted values hold line breaks; a file is still read by many tasks.
    """
    encoding = ENCODINGS[extract.source_system]
    path = f"{folder}/{extract.path}"
    names = header(spark, path, encoding)
    absent = [c for c in extract.columns if c not in names]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if line_breaks:
        raw = parsed(read_records(spark, path, encoding), schema).select(
            "values.*", F.struct(F.col("file").alias("file"), F.col("offset").alias("offset"), F.col("row").alias("row")).alias(SEQUENCE))
    else:
        # Parsing only the columns that are asked for would let rows of another length pass.
        exact = {"header": True, "encoding": encoding, "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": False}
        raw = spark.read.schema(schema).options(**exact).csv(path).withColumn(SEQUENCE, file_position())
    repair = encoding != "UTF-8" and not strict_encoding

    def value(column: str) -> Column:
        text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
        return (repaired(text) if repair else text).alias(column)

    return raw.select(*[value(c) for c in extract.columns], SEQUENCE)


def read_all(spark: SparkSession, folder: str, strict_encoding: bool = False,
             line_breaks: bool = False) -> dict[str, DataFrame]:
    validate_files(spark, folder)
    return {e.name: read_extract(spark, folder, e, strict_encoding, line_breaks) for e in EXTRACTS}
