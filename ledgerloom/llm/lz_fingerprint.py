"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into LZ78 phrases: each is the longest phrase seen before plus one character. The hashes of the phrase set
make a minimum-hash signature: a hash picks one of ``SLOTS`` slots, the least hash of a slot counts, an empty slot borrows
from the next filled one, and eight bits of each slot are kept. Equal texts have equal signatures, and two signatures agree
in about as many slots as the phrase sets have in common, as two texts that compress each other well do.
"""

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import by_value, packed, unpacked
from ledgerloom.llm.hashing import Stretches, mix
from ledgerloom.session import cut

SLOTS = 128
BITS = 7  # of a hash, to pick the slot
CHUNK = 1 << 16  # phrases that are hashed at once
EMPTY = "0" * (2 * SLOTS)

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
EDGE = "part int, place string, own_id long, own string, own_print string"


def parse(text: str, at: int, stop: int, node: dict, root: dict) -> tuple[list[int], dict, list[tuple[dict, str]]]:
    """Parse ``text[at:stop]`` on from ``node`` of the phrase tree: where phrases end, the node it stands at, and the
    branches that were added, so that they can be taken off again."""
    ends, added = [], []
    for i, c in enumerate(text[at:stop], at + 1):
        below = node.get(c)
        if below is None:
            node[c] = {}
            added.append((node, c))
            ends.append(i)
            node = root
        else:
            node = below
    return ends, node, added


def hashes(text: str, start: int, ends: list[int]) -> np.ndarray:
    """64-bit hashes of the phrases that follow each other from ``start``: polynomials of their code points, mixed."""
    found = []
    for k in range(0, len(ends), CHUNK):
        part = np.array(ends[k:k + CHUNK], dtype=np.int64)
        codes = np.frombuffer(text[start:part[-1]].encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        stop = part - start
        begin = np.concatenate([[0], stop[:-1]])
        found.append(mix(Stretches(codes).raw(begin, stop) + (stop - begin).astype(np.uint64)))
        start = int(part[-1])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def least(values: np.ndarray) -> np.ndarray:
    """The least hash of each slot that has one, in the order of slots."""
    slot_first = np.sort((values << np.uint64(64 - BITS)) | (values >> np.uint64(BITS)))
    slots = slot_first >> np.uint64(64 - BITS)
    first = np.ones(len(slots), dtype=bool)
    first[1:] = slots[1:] != slots[:-1]
    return slot_first[first]


def signature(minima: np.ndarray) -> str:
    """Eight bits of every slot, in hex; a text without phrases has zeros."""
    if not len(minima):
        return EMPTY
    slots = (minima >> np.uint64(64 - BITS)).astype(np.int64)
    low = (minima & np.uint64(0xFF)).astype(np.uint8)
    donor = np.searchsorted(slots, np.arange(SLOTS)) % len(slots)
    return low[donor].tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal slots, less those that agree by chance; 0 between a text with phrases and one without."""
    if a == b:
        return 1.0
    if EMPTY in (a, b):
        return 0.0
    same = np.frombuffer(bytes.fromhex(a), np.uint8) == np.frombuffer(bytes.fromhex(b), np.uint8)
    return max(0.0, (float(same.mean()) - 1 / 256) / (1 - 1 / 256))


class Parsed:
    """A text's fingerprint, and its parse up to the half, from which an edited text goes on."""

    def __init__(self, text: str):
        self.text = text
        self.kept = len(text) - len(text) // 2
        self.root: dict = {}
        ends, self.node, _ = parse(text, 0, self.kept, self.root, self.root)
        self.at = ends[-1] if ends else 0  # an open phrase begins here
        self.shared = hashes(text, 0, ends)
        self.print = self._go_on(text)

    def _go_on(self, text: str) -> str:
        ends, _, added = parse(text, self.kept, len(text), self.node, self.root)
        for node, c in reversed(added):
            del node[c]
        return signature(least(np.concatenate([self.shared, hashes(text, self.at, ends)])))

    def edited(self, following: str) -> tuple[str, str]:
        """The edited text and its fingerprint."""
        text = self.text[:self.kept] + following[:len(self.text) - self.kept]
        return text, self._go_on(text)


def fingerprint(text: str | None) -> str:
    return Parsed(text or "").print


def compare(doc_id: int | None, own: Parsed, following: str, following_print: str) -> tuple:
    text, edited_print = own.edited(following)
    return (doc_id, len(own.text), hashlib.sha256(text.encode()).hexdigest(), own.print, edited_print,
            likeness(own.print, edited_print), likeness(own.print, following_print))


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _columns(schema: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [field.split() for field in schema.split(", ")]
    return [p[0] for p in pairs], [_TYPES[p[1]] for p in pairs]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the neighbours of a sorted partition; its first and last document come out with their texts as edges."""
    names, types = _columns(f"{RESULT}, {EDGE}")
    held, blank = None, (None,) * 7
    for batch in batches:
        rows = []
        gc.disable()  # the phrase trees hold no cycles, and the collector would walk them over and over
        try:
            parts, ids = (batch.column(c).to_pylist() for c in ("part", "id"))
            for part, doc_id, raw in zip(parts, ids, unpacked(batch.column("packed"))):
                now = (part, doc_id, Parsed(raw.decode()))
                if held is None:
                    rows.append((*blank, part, "first", doc_id, now[2].text, now[2].print))
                else:
                    rows.append((*compare(held[1], held[2], now[2].text, now[2].print), *(None,) * 5))
                held = now
        finally:
            gc.enable()
        yield _table(rows, names, types)
    if held is not None:
        yield _table([(*blank, held[0], "last", held[1], held[2].text, held[2].print)], names, types)


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = _columns(RESULT)
    for batch in batches:
        rows = [compare(doc_id, Parsed(own), following, its_print)
                for doc_id, own, following, its_print in zip(*(c.to_pylist() for c in batch.columns))]
        yield _table(rows, names, types)


def neighbour_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every document its fingerprint, that of its edited text, and how like they and the next document's are.

    A document's second half (the last floor(n / 2) code points) is edited into as much of the start of the next document,
    by ascending id; after the last comes the first. Null ids come before all others and rows with equal ids follow a hash
    of their texts; a single document follows itself. A null text counts as empty; two texts without phrases are alike (1),
    one with and one without are not (0). An empty table gives an empty result; other columns are not looked at.

    The texts are range-sorted once. Neighbours meet in a partition; between partitions only the first and the last
    document of each are joined.
    """
    order = ["id", "tie"]
    keyed = docs.select(F.col(id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"), packed(F.col(text)).alias("packed"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = ordered.select(F.spark_partition_id().alias("part"), "id", "packed")
    done = cut(parts.mapInArrow(_in_order, f"{RESULT}, {EDGE}"))
    first, last = (done.where(F.col("place") == place) for place in ("first", "last"))
    # One narrow row per partition; the texts are joined to it.
    every = Window.orderBy("part")
    start = F.min("part").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    around = first.select("part", F.coalesce(F.lead("part").over(every), start).alias("next"))
    following = first.select(F.col("part").alias("next"), F.col("own").alias("following"), F.col("own_print").alias("its_print"))
    pairs = last.join(around, "part").join(following, "next").select("own_id", "own", "following", "its_print")
    columns = _columns(RESULT)[0]
    return done.where(F.col("place").isNull()).select(*columns).union(pairs.mapInArrow(_at_edges, RESULT))


by_value(__name__)
