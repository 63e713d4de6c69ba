"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

A fingerprint has 8 positional bytes (position, value). Fingerprints that differ in at most d bits differ in at most d
bytes, so they share at least T = 8 - d positional bytes. Posting lists of single positional bytes would each hold 1/256
of the corpus; here a list stands for T of them at once (every choice of T positions), so two fingerprints meet in a list
exactly when their tally reaches T. Members of a list agree in T bytes, so it holds at most 256 ** d distinct fingerprints
however large the corpus is, and tallies and bits are verified inside the list. A list answers with links to one
representative of each of its connected parts instead of all pairs, which keeps every connection and stays linear.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import array_udf, by_value, unused
from ledgerloom.llm.components import components
from ledgerloom.session import cut

SEED = 42
CHUNK = 1 << 15


def _fingerprints(words: int):
    """The SimHash of each text's word shingles; bit i is set if it is set in over half of the shingles' hashes."""

    def shingles(raw: bytes) -> list[bytes]:
        # bytes.lower folds A-Z only, bytes.split cuts at the six ASCII spaces.
        tokens = raw.lower().split()
        if len(tokens) <= words:
            return [b" ".join(tokens)] if tokens else []
        joined, ends, at = b" ".join(tokens), [], -1
        for token in tokens:
            at += len(token) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        return [joined[s:e] for s, e in zip(starts, ends[words - 1:])]

    def of(texts: pa.Array) -> pa.Array:
        prints, digest = [], xxhash.xxh64_intdigest
        for raw in texts.cast(pa.binary()).to_pylist():
            parts = shingles(raw or b"")
            ones = np.zeros(64, dtype=np.int64)
            for k in range(0, len(parts), CHUNK):
                part = parts[k:k + CHUNK]
                hashes = np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=len(part))
                ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            bits = (2 * ones > len(parts)).astype(np.uint8)
            prints.append(np.packbits(bits, bitorder="little").view("<i8")[0])
        return pa.array(prints, pa.int64())

    return of


def simhash(text: Column, words: int) -> Column:
    """The 64-bit fingerprint as a signed long; 0 for a text without words or a null one."""
    return array_udf(lambda: _fingerprints(words), "long")(text)


def _list_links(max_bits: int):
    """Links inside each posting list: from every fingerprint to the least one of its connected part of the list."""

    def links(prints: np.ndarray) -> list[tuple[int, int]]:
        unsigned = prints.astype(np.uint64)
        where = {int(v): i for i, v in enumerate(unsigned)}
        free = int(np.bitwise_or.reduce(unsigned ^ unsigned[0]))
        bits = [1 << i for i in range(64) if free >> i & 1]
        flips = [sum(c) for n in range(1, max_bits + 1) for c in combinations(bits, n)]
        found, seen = [], set()
        for i, v in enumerate(where):
            if i in seen:
                continue
            part, todo = [i], [v]
            seen.add(i)
            while todo:
                x = todo.pop()
                # A part of few members is quicker to compare with all, a large one by its neighbours' values.
                near = np.flatnonzero(np.bitwise_count(unsigned ^ np.uint64(x)) <= max_bits) if len(where) <= 4 * len(flips) else (
                    where[x ^ f] for f in flips if x ^ f in where
                )
                for j in near:
                    if int(j) not in seen:
                        seen.add(int(j))
                        part.append(int(j))
                        todo.append(int(unsigned[j]))
            least = min(prints[p] for p in part)
            found += [(int(prints[p]), int(least)) for p in part if prints[p] != least]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [link for prints in batch.column(0) for link in links(prints.values.to_numpy())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

    return run


def link_fingerprints(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints which differ in at most ``max_bits`` bits, directly or in a chain.
    ``prints`` has one column ``fingerprint`` of distinct longs."""
    masks = []
    for kept in combinations(range(8), 8 - max_bits):
        mask = sum(0xFF << (8 * p) for p in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    indexed = prints.select("fingerprint", F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("list", "mask"))
    posting = F.col("fingerprint").bitwiseAND(F.col("mask"))
    lists = indexed.groupBy("list", posting.alias("shared")).agg(F.collect_list("fingerprint").alias("members"))
    return lists.where(F.size("members") > 1).select("members").mapInArrow(_list_links(max_bits), "u long, v long").distinct()


def _connected(narrow: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint, least, root``: every fingerprint's smallest id and the fingerprint that stands for its component."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3")
    classes = cut(narrow.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    links = cut(link_fingerprints(classes.select("fingerprint"), max_bits))
    roots = components(links)
    return classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )


def simhash_components(docs: DataFrame, words: int, max_bits: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for every document.

    Texts are lower-cased in A-Z and cut into shingles of ``words`` words at ASCII white space; a shorter text is one
    shingle, a text without words or a null one has fingerprint zero and is linked like any other. ``component_id`` is the
    smallest id that links of at most ``max_bits`` (0 to 3) bits reach, null ids aside. Repeated rows share a fingerprint. An empty
    table gives an empty result; other columns are not looked at.
    """
    narrow = cut(docs.select(F.col(id).alias("doc_id"), simhash(F.col(text), words).alias("fingerprint")))
    grouped = _connected(narrow, max_bits)
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(grouped.join(least, "root").select("fingerprint", "component_id"))
    return narrow.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, words: int, max_bits: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, or any if all its ids are null.

    Rows are told apart by id and text. Of a component's rows that share the smallest id, one text is kept, once. Null texts and
    texts without words are one component; an empty table gives an empty result. Columns of any name come back as they are.
    """
    same, turn, row_id, row_hash, row_count = unused(docs, "same", "turn", "row_id", "row_hash", "row_count")
    same_text = F.xxhash64(text)
    narrow = cut(docs.select(F.col(id).alias("doc_id"), same_text.alias("hash"), simhash(F.col(text), words).alias("fingerprint")))
    first = F.min(F.struct(F.col("least").isNull().alias("unknown"), "least", "fingerprint")).alias("first")
    firsts = _connected(narrow, max_bits).groupBy("root").agg(first).select("root", "first.*")
    kept = narrow.join(firsts, "fingerprint").where(F.col("doc_id").eqNullSafe(F.col("least")))
    kept = kept.groupBy("root", "doc_id", "hash").agg(F.count("*").alias("rows"))
    kept = kept.groupBy("root").agg(F.min(F.struct("doc_id", "hash", "rows")).alias("row"))
    kept = cut(kept.select(F.col("row.doc_id").alias(row_id), F.col("row.hash").alias(row_hash), F.col("row.rows").alias(row_count)))

    def found(rows: DataFrame) -> DataFrame:
        keyed = docs.withColumn(same, same_text)
        return keyed.join(rows, keyed[same].eqNullSafe(rows[row_hash]) & keyed[id].eqNullSafe(rows[row_id]), "left_semi")

    once = found(kept.where(F.col(row_count) == 1)).select(*docs.columns)
    repeated = kept.where(F.col(row_count) > 1)
    if repeated.isEmpty():
        return once
    # Only rows that come several times need a shuffle of whole documents.
    number = F.row_number().over(Window.partitionBy(id, same).orderBy(F.lit(1)))
    return once.union(found(repeated).withColumn(turn, number).where(F.col(turn) == 1).select(*docs.columns))


by_value(__name__)
