"""Finding windows that repeat: the distributed part that substring operators share.

A text is a sequence of symbols and a window is ``length`` of them in a row. Every window has a seed: the ``seed`` long
stretch in it with the least hash (the leftmost of equals). Equal windows have equal seeds at equal places, so windows need
to be compared only where seeds agree. Neighbouring windows mostly share a seed and form one segment.

1. Seeds are counted. A filter remembers those that come more than once; when they are too many for it, segments are joined
   with them by a shuffle.
2. Segments with such seeds are compared as wholes by a hash of their symbols. Most repeats end here: all but the first of
   equal segments repeat it in every window.
3. What is left is one segment of each kind. Where a seed has several kinds, they are handed to the operator's own method,
   with their symbols, a group for each seed. A seed with very many kinds would make too large a group: its windows are
   compared one by one, by their hashes.

Rows of one kind are merged in every task before they are shuffled, and no group holds all rows of a common passage.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import by_value, packed, ship, unpacked
from ledgerloom.llm.hashing import Stretches, mix
from ledgerloom.operators.joins import lookup
from ledgerloom.session import cut

FILTER_BITS = 27  # the filter has 2 ** 27 bits, 16 MB, whatever the input
FILTER_SEEDS = 1 << 23  # repeated seeds that it is used for, at most
KINDS = 1024  # segments of one seed that are compared in one group
CHUNK = 1 << 16  # symbols that are hashed at a time

NAMES = ["doc_id", "tie", "first", "n", "seed", "kind", "times"]
TYPES = [*[pa.int64()] * 7, pa.binary()]
RANGE = "doc_id long, tie long, first long, n long"
SEGMENT = "doc_id long, tie long, first long, n long, seed long, kind long, times long"
PART = f"{SEGMENT}, symbols binary"


@dataclass(frozen=True)
class Scheme:
    """How texts become symbols, and the lengths of windows and seeds. ``of`` makes a function of UTF-8 bytes, per task."""

    of: Callable[[], Callable[[bytes], np.ndarray]]
    length: int
    seed: int


@dataclass
class Found:
    """Segments of a chunk: index of the text, first window, number of windows, seed and kind."""

    text: np.ndarray
    first: np.ndarray
    n: np.ndarray
    seed: np.ndarray
    kind: np.ndarray


def numbers(symbols: np.ndarray) -> np.ndarray:
    return symbols.astype(np.uint64) + np.uint64(1)


def segments(sequences: list[np.ndarray], scheme: Scheme) -> Found:
    length, width = scheme.length, scheme.length - scheme.seed + 1
    sizes = np.array([len(s) for s in sequences], dtype=np.int64)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        none = np.zeros(0, dtype=np.int64)
        return Found(none, none, none, none, none)
    hashed = Stretches(numbers(np.concatenate(sequences)))
    grams = mix(hashed.raw_all(scheme.seed))
    # The place in the low half: the least number is the least hash, and of equals the leftmost.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    text = np.repeat(np.arange(len(sizes)), windows)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[text]
    anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.append(head, len(anchor)))
    start, anchor, text = at[head], anchor[head], text[head]
    place = ((anchor - start) << 32 | n).astype(np.uint64)
    kind = mix(hashed.raw(start, start + n - 1 + length) ^ mix(place + np.uint64(1)))
    return Found(text, start - begin[text], n, mix(grams[anchor] + np.uint64(1)).view(np.int64), kind.view(np.int64))


def in_chunks(batch: pa.RecordBatch, scheme: Scheme, of: Callable[[bytes], np.ndarray]) -> Iterator[tuple[list[int], Found]]:
    """Row numbers of some texts of the batch, and their segments. A long text is taken in stretches that share a window less
    one symbol, so that every window is in one of them."""
    rows, starts, sequences, total = [], [], [], 0

    def found() -> tuple[list[int], Found]:
        here = segments(sequences, scheme)
        here.first = here.first + np.array(starts, dtype=np.int64)[here.text]
        return rows, here

    for row, raw in enumerate(batch.column("text").cast(pa.binary())):
        symbols = of(raw.as_py() or b"")
        for start in range(0, len(symbols) - scheme.length + 1, CHUNK):
            rows.append(row)
            starts.append(start)
            sequences.append(symbols[start:start + CHUNK + scheme.length - 1])
            total += len(sequences[-1])
            if total >= CHUNK:
                yield found()
                rows, starts, sequences, total = [], [], [], 0
    if rows:
        yield found()


def _collected(batch: pa.RecordBatch, scheme: Scheme, of, passes: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, Found]:
    parts = []
    for rows, found in in_chunks(batch, scheme, of):
        here = passes(found.seed) if passes else slice(None)
        parts.append((np.array(rows)[found.text[here]], found.first[here], found.n[here], found.seed[here], found.kind[here]))
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * 5
    return columns[0], Found(*columns)


def _seed_counts(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scheme.of()
        for batch in batches:
            seeds, n = np.unique(_collected(batch, scheme, of)[1].seed, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seeds), pa.array(n)], ["seed", "n"])

    return run


def repeated_seeds(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """``seed``: those that come more than once."""
    counts = docs.select("text").mapInArrow(_seed_counts(scheme), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    return cut(counts.where(F.col("n") > 1).select("seed"))


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bitmap of the seeds' low bits."""
    word = F.expr(f"shiftright(seed & {(1 << FILTER_BITS) - 1}L, 6)").alias("word")
    bits = F.expr("bit_or(shiftleft(1L, cast(seed & 63 AS int)))").alias("bits")
    words = seeds.groupBy(word).agg(bits).toArrow()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap


def _passes(bitmap: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def of(seeds: np.ndarray) -> np.ndarray:
        low = seeds & ((1 << FILTER_BITS) - 1)
        return bitmap[low >> 6] >> (low & 63) & 1 == 1

    return of


def _merged(batch: pa.RecordBatch, row: np.ndarray, found: Found, keep_first: bool) -> list[pa.Array]:
    """Columns of ``SEGMENT``. Of equal segments of a batch only the first (by document, then place) goes on, with their
    number. What is settled by that comes out as ranges, joined where they follow each other, without a seed."""
    ids, ties = batch.column("doc_id"), batch.column("tie").to_numpy()
    known, number = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    order = np.lexsort((found.first, ties[row], number[row], known[row], found.kind, found.seed))
    row, first, n, seed, kind = (c[order] for c in (row, found.first, found.n, found.seed, found.kind))
    head = np.ones(len(row), dtype=bool)
    head[1:] = (seed[1:] != seed[:-1]) | (kind[1:] != kind[:-1])
    at = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    times = np.diff(np.append(at, len(row)))[group] if len(row) else n
    if keep_first and len(row):
        # Rows that repeat a document as a whole are one document: its first place is nowhere earlier.
        own = at[group]
        again = ~head & (first == first[own])
        for c in (ties, number, known):
            again &= c[row] == c[row[own]]
        row, first, n, seed, kind, times, head = (c[~again] for c in (row, first, n, seed, kind, times, head))
    settled = ~head if keep_first else times > 1
    ranges = joined(row[settled], first[settled], n[settled])
    none = pa.nulls(len(ranges[0]), pa.int64())
    picked = pa.array(np.concatenate([row[head], ranges[0]]))
    return [ids.take(picked), batch.column("tie").take(picked),
            pa.array(np.concatenate([first[head], ranges[1]])), pa.array(np.concatenate([n[head], ranges[2]])),
            *(pa.concat_arrays([pa.array(c[head]), none]) for c in (seed, kind, times))]


def _segments(scheme: Scheme, shipped, keep_first: bool):
    """Segments whose seeds may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, passes = scheme.of(), _passes(shipped.value["bitmap"]) if shipped else None
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_merged(batch, *_collected(batch, scheme, of, passes), keep_first), NAMES)

    return run


def joined(owner: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of windows as fewer and longer ones: those of an owner that follow each other become one."""
    order = np.lexsort((first, owner))
    owner, first, n = owner[order], first[order], n[order]
    if not len(owner):
        return owner, first, n
    head = np.concatenate([[True], (owner[1:] != owner[:-1]) | (first[1:] != first[:-1] + n[:-1])])
    return owner[head], first[head], np.add.reduceat(n, np.flatnonzero(head))


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Texts with their id, and a 64-bit hash that tells rows of one id apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id).alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"))


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])


def with_ranges(docs: DataFrame, ranges: DataFrame, fields: list[str]) -> DataFrame:
    """Texts, compressed as they are shuffled, with an array of what ``ranges`` has for them, null if nothing."""
    docs = docs.select("doc_id", "tie", packed(F.col("text")).alias("packed"))
    gathered = ranges.groupBy("doc_id", "tie").agg(F.collect_list(F.struct(*fields)).alias("ranges"))
    return docs.join(gathered, same_document(docs, gathered), "left").select(docs["doc_id"], docs["tie"], docs["packed"], gathered["ranges"])


def _parts(scheme: Scheme, keep_first: bool):
    """The segments that must be compared window by window: with their symbols, or, of a crowded seed, as windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scheme.of()
        for batch in batches:
            rows, windows = [], []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "tie", "ranges"))
            for at, (raw, doc_id, tie, ranges) in enumerate(zip(unpacked(batch.column("packed")), *columns)):
                symbols = of(raw)
                for r in ranges:
                    first, n, seed = r["first"], r["n"], r["seed"]
                    part = symbols[first:first + n - 1 + scheme.length]
                    if r["crowded"]:
                        kinds = mix(Stretches(numbers(part)).raw_all(scheme.length)).view(np.int64)
                        windows.append((np.full(n, at), first + np.arange(n), np.full(n, seed), kinds))
                    else:
                        rows.append((doc_id, tie, first, n, seed, 0, None, part.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], [*NAMES, "symbols"])
            if windows:
                row, first, seed, kind = (np.concatenate(c) for c in zip(*windows))
                merged = _merged(batch, row, Found(row, first, np.ones(len(row), dtype=np.int64), seed, kind), keep_first)
                yield pa.RecordBatch.from_arrays([*merged, pa.nulls(len(merged[0]), pa.binary())], [*NAMES, "symbols"])

    return run


def groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Rows (seed, doc_id, tie, first, symbols) of whole groups of a partition that is sorted by seed, many groups at a
    time, up to about ``most`` bytes of symbols."""
    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "doc_id", "tie", "first", "symbols"))):
            if size >= most and row[0] != last:
                yield held
                held, size = [], 0
            held.append(row)
            last = row[0]
            size += len(row[4])
    if held:
        yield held


def as_ranges(rows: list[tuple], owner: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Windows (index of their row, place in it) as ranges of windows that follow each other."""
    owner, place, n = joined(owner, place, np.ones(len(owner), dtype=np.int64))
    found = [(*rows[o][1:3], rows[o][3] + p, k) for o, p, k in zip(owner.tolist(), place.tolist(), n.tolist())]
    columns = list(zip(*found)) if found else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4)], ["doc_id", "tie", "first", "n"]
    )


def covered(size: int, ranges: list[dict] | None, length: int) -> np.ndarray:
    """Which symbols the windows of the ranges cover."""
    gone = np.zeros(size, dtype=bool)
    if ranges:
        first = np.array([r["first"] for r in ranges])
        order = np.argsort(first)
        first, end = first[order], np.maximum.accumulate((first + np.array([r["n"] for r in ranges]) - 1 + length)[order])
        head = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
        for start, stop in zip(first[head].tolist(), end[np.append(head[1:], len(end)) - 1].tolist()):
            gone[start:stop] = True
    return gone


def _compared(rows: DataFrame, keep_first: bool) -> DataFrame:
    """``repeats``: whether a row's seed and kind come elsewhere too, or earlier; ``goes_on``: one row of each kind. Every
    task has left one row of a kind at most per batch, so that no kind is large."""
    kind = Window.partitionBy("seed", "kind")
    if keep_first:
        place = F.struct("doc_id", "tie", "first")  # nulls come first
        return rows.withColumn("repeats", place > F.min(place).over(kind)).withColumn("goes_on", ~F.col("repeats"))
    rows = rows.withColumn("repeats", F.sum("times").over(kind) > 1)
    return rows.withColumn("goes_on", F.row_number().over(kind.orderBy("doc_id", "tie", "first")) == 1)


def repeated_windows(texts: DataFrame, scheme: Scheme, solve: Callable, keep_first: bool) -> DataFrame:
    """``RANGE`` rows: the windows that come elsewhere too, or, with ``keep_first``, that come earlier too (in a document of a
    smaller id, or earlier in the same one; null ids are smallest, rows of one id follow a hash of their texts). ``solve``
    maps partitions of ``PART`` rows, sorted by seed, to such ranges. Ranges may overlap."""
    seeds = repeated_seeds(texts, scheme)
    if seeds.count() <= FILTER_SEEDS:
        shipped = ship(texts.sparkSession, bitmap=seed_filter(seeds))
        every = cut(texts.mapInArrow(_segments(scheme, shipped, keep_first), SEGMENT))
    else:
        rows = texts.mapInArrow(_segments(scheme, None, keep_first), SEGMENT)
        # What a batch has settled has no seed any more.
        every = cut(rows.where(F.col("seed").isNotNull()).join(seeds, "seed", "left_semi").select(*rows.columns)
                    .union(rows.where(F.col("seed").isNull())))
    one = cut(_compared(every.where(F.col("seed").isNotNull()), keep_first).drop("kind", "times"))
    kinds = one.where("goes_on")
    many = kinds.groupBy("seed").agg(F.count("*").alias("kinds"), F.min("repeats").alias("done")).where("kinds > 1 and not done")
    open_ = lookup(kinds, cut(many.select("seed", "kinds")), {"seed": "seed"}, {"kinds": "kinds"}).where("kinds IS NOT NULL")
    open_ = open_.withColumn("crowded", F.col("kinds") > KINDS)
    parts = with_ranges(texts, open_, ["seed", "first", "n", "crowded"]).where(F.col("ranges").isNotNull())
    parts = cut(parts.mapInArrow(_parts(scheme, keep_first), PART))
    solved = parts.where(F.col("symbols").isNotNull()).repartition("seed").sortWithinPartitions("seed").mapInArrow(solve, RANGE)
    alone = parts.where(F.col("symbols").isNull()).drop("symbols")
    found = [every.where(F.col("seed").isNull()), one.where("repeats"), solved, alone.where(F.col("seed").isNull()),
             _compared(alone.where(F.col("seed").isNotNull()), keep_first).where("repeats")]
    return reduce(DataFrame.union, [rows.select("doc_id", "tie", "first", "n") for rows in found])


by_value(__name__)
