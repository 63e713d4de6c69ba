"""Sharding by a Feistel permutation of global row numbers: shard and slot are formulas of a row's number."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.feistel import permute
from ledgerloom.operators.keys import assign_keys
from ledgerloom.session import cut


def assign_shards(rows: DataFrame, order: list[str], shards: int, seed: str = "shards") -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard); shard sizes differ by one at most.

    Rows are numbered by ``order``, nulls first, and the permutation of the numbers depends on ``seed`` and the row count
    only, so a rerun deals alike and any row can be found by its number. Rows that agree in all of ``order`` get
    neighbouring numbers in any order among themselves, so name enough columns to tell rows apart. Columns called
    ``shard`` or ``slot`` are replaced. An empty table gives an empty result.
    """
    rows = cut(rows.drop("shard", "slot"))
    total = rows.count()
    place = permute(F.col("_row"), F.lit(total).cast("long"), F.lit(seed))
    placed = assign_keys(rows, "_row", order, first=0).withColumn("_place", place)
    return placed.select(
        *rows.columns,
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text", seed: str = "shards") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every document.

    Size is the UTF-8 length plus 8; a null text has length 0 and the checksum of an empty one. Numbers follow id, then
    size and checksum; rows equal in all three give equal results up to their places.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(id).alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    return assign_shards(narrow, ["doc_id", "size", "text_crc32"], shards, seed)
