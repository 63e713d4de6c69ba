"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition is a node with a run of digests. In each binomial round, ``fan`` nodes whose numbers differ in one
digit exchange their runs: a row moves to the partner whose digit equals the digest's digit of that round. Each node then
merges what it received, in sorted order, and keeps one row per digest. After the last round a digest has one node, and
at no time more than ``fan`` rows of a digest meet in a node, however large its group is.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import array_udf, by_value, unused
from ledgerloom.session import cut

FAN = 8

DIGEST = "struct<digest:long,sha:string,bytes:long>"
KEY = ["digest", "sha", "bytes"]
RUN = "slot int, digest long, sha string, bytes long, keep_id long, group_size long"


def _digests():
    """A short digest to sort by, and the SHA-256 and length that verify it. ``bytes.lower`` folds A-Z only."""

    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for raw in texts.cast(pa.binary()).to_pylist():
            raw = (raw or b"").lower()
            rows.append((xxhash.xxh3_64_intdigest(raw) - (1 << 63), hashlib.sha256(raw).hexdigest(), len(raw)))
        short, sha, size = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(short, pa.int64()), pa.array(sha, pa.string()), pa.array(size, pa.int64())], ["digest", "sha", "bytes"]
        )

    return of


def text_digest(text: Column) -> Column:
    return array_udf(_digests, DIGEST)(text)


def _merge(largest: bool):
    """Merge equal keys of a partition that is sorted by slot and key; the last key of a batch waits for the next batch."""
    keys, best = ["slot", *KEY], "max" if largest else "min"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            # Spark marks a counted column as not null in some rounds only.
            table = pa.Table.from_arrays(batch.columns, names)
            table = pa.concat_tables([waiting, table]) if waiting is not None else table
            table = table.group_by(keys, use_threads=False).aggregate([("keep_id", best), ("group_size", "sum")])
            table = table.rename_columns([n.removesuffix("_" + best).removesuffix("_sum") for n in table.column_names]).select(names)
            last = table.slice(table.num_rows - 1).to_pylist()[0]
            same = pc.and_(pc.equal(table["slot"], last["slot"]), pc.equal(table["sha"], last["sha"]))
            waiting = table.filter(same)
            yield from table.filter(pc.invert(same)).combine_chunks().to_batches()
        if waiting is not None:
            yield from waiting.combine_chunks().to_batches()

    return run


def merge_runs(digests: DataFrame, largest: bool, fan: int = FAN, nodes: int | None = None) -> DataFrame:
    """One row per digest: its kept id and its number of rows. ``digests`` has ``id`` and the columns of ``KEY``."""
    nodes = nodes or max(digests.rdd.getNumPartitions(), 2)
    rounds = 1
    while fan**rounds < nodes:
        rounds += 1
    slots = fan**rounds
    runs = digests.select(
        F.pmod(F.spark_partition_id(), F.lit(slots)).cast("int").alias("slot"), *KEY,
        F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
    )
    runs = runs.sortWithinPartitions("slot", *KEY).mapInArrow(_merge(largest), RUN)
    for step in range(rounds):
        unit = fan**step
        moved = F.expr(f"slot - (slot div {unit} % {fan}) * {unit} + (pmod(digest, {slots}) div {unit} % {fan}) * {unit}")
        runs = runs.withColumn("slot", moved.cast("int")).repartitionById(slots, "slot")
        runs = runs.sortWithinPartitions("slot", *KEY).mapInArrow(_merge(largest), RUN)
    return runs.drop("slot")


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(id).alias("id"), text_digest(F.col(text)).alias("d")).select("id", "d.*")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """One row per document: ``id``, ``keep_id``, ``group_size``, ``kept`` and ``sha``.

    Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty. The smallest id of a
    group is kept, or the largest if asked for. A null id is kept only if its whole group has null ids. Rows are told
    apart by id: rows that repeat both id and text each count in ``group_size`` and share the verdict. An empty table
    gives an empty result; other columns of ``docs`` are not looked at.
    """
    narrow = cut(digests(docs, id, text))
    groups = merge_runs(narrow, largest)
    joined = narrow.join(groups, KEY)
    return joined.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha")


def drop_exact_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the kept id; of rows that repeat it, any one.

    Null and empty texts are one group; a row with a null id stays only if its whole group has null ids. An empty table gives an
    empty result. Columns of any name come back as they are.
    """
    digest, again, *keys = unused(docs, "digest", "again", "known", "number", "sha")
    known, number = F.col("id").isNotNull(), F.coalesce("id", F.lit(0))
    kept = exact_groups(docs, id, text, largest).where("kept").select(known.alias(keys[0]), number.alias(keys[1]), F.col("sha").alias(keys[2]))
    keyed = docs.withColumn(digest, text_digest(F.col(text))).select(
        *docs.columns, F.col(id).isNotNull().alias(keys[0]), F.coalesce(id, F.lit(0)).alias(keys[1]), F.col(f"{digest}.sha").alias(keys[2])
    )
    one = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    return keyed.join(kept.distinct(), keys, "left_semi").withColumn(again, one).where(F.col(again) == 1).select(*docs.columns)


by_value(__name__)
