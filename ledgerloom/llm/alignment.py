"""Alignment of two tokenizers' tokens over the same text, by the bytes they cover.

A is a byte-level BPE vocabulary, B a SentencePiece model that puts a space in front. Every token covers a range of bytes of the
text with a space in front. Within a batch ``merge_asof``, keyed by document, finds for each token's start the other side's
covering token; both directions together are the overlaps. Where two overlapping tokens end alike, both sides end, and such
ends cut the tokens into groups.

Very long texts are taken in pieces that end between words, where both sides end; pieces are aligned one after the other.
"""

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import by_value, kept, ship
from ledgerloom.session import cut

MARK = "▁"
PIECE_CHARS = 1 << 20  # a longer text is taken in pieces of about this length
BATCH_CHARS = 1 << 20  # texts that are aligned at a time
ID_BITS = 20  # of a token id within a pair's number
LARGE_GROUP = 1 << 16  # a group with more links is counted by its distinct ids
PAIRS_IN_A_ROW = 1 << 20
BROADCAST_PAIRS = 500_000  # only so many pairs, the most frequent ones, are ever sent to all tasks
# Fixed value: how a byte-level vocabulary of this kind cuts a text before it merges bytes.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Both tokenizers start anew at a space between two letters or digits.
BETWEEN_WORDS = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def byte_characters() -> dict[str, int]:
    """What stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def byte_ranks(vocabulary: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level vocabulary file whose merges stand in the order of their ids."""
    model, stands = json.loads(vocabulary)["model"], byte_characters()
    ids = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if len(stands) + len(merges) != len(ids) or any(ids[a + b] != len(stands) + k for k, (a, b) in enumerate(merges)):
        raise ValueError("ids of the vocabulary do not follow its merges")
    return {bytes(stands[c] for c in token): i for token, i in ids.items()}


@dataclass
class Side:
    """One side's ids of many texts, one after the other."""

    ids: np.ndarray
    text: np.ndarray  # which text a token is of
    ends: np.ndarray  # in bytes, through all texts

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends


@dataclass
class Aligned:
    """Texts that both sides give back, by their places in the batch, and their tokens with the number of each one's group."""

    places: np.ndarray
    a: Side
    b: Side
    overlaps: np.ndarray  # rows of two token numbers, sorted
    group_ends: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray

    def text_bounds(self, side: Side) -> np.ndarray:
        return np.searchsorted(side.text, np.arange(len(self.places) + 1))

    def group_bounds(self) -> np.ndarray:
        last = self.text_bounds(self.a)[1:] - 1
        return np.concatenate([[0], self.a_group[last] + 1]) if len(last) else np.zeros(1, dtype=np.int64)


def covering(left: Side, right: Side) -> np.ndarray:
    """For each token of ``left`` the token of ``right`` that covers its start."""
    starts = pd.DataFrame({"at": left.starts, "text": left.text})
    others = pd.DataFrame({"at": right.starts, "text": right.text, "other": np.arange(len(right.ids))})
    return pd.merge_asof(starts, others, on="at", by="text")["other"].to_numpy(dtype=np.int64)


def align_sides(places: np.ndarray, a: Side, b: Side) -> Aligned:
    over_a, over_b = covering(a, b), covering(b, a)
    own_a, own_b = np.arange(len(a.ids)), np.arange(len(b.ids))
    alone = b.starts != a.starts[over_b]  # equal starts are found from both sides
    overlaps = np.concatenate([np.stack([own_a, over_a], axis=1), np.stack([over_b, own_b], axis=1)[alone]])
    overlaps = overlaps[np.lexsort((overlaps[:, 1], overlaps[:, 0]))]
    last = overlaps[a.ends[overlaps[:, 0]] == b.ends[overlaps[:, 1]]]
    groups = []
    for side, tokens in ((a, last[:, 0]), (b, last[:, 1])):
        ends = np.zeros(len(side.ids), dtype=np.int64)
        ends[tokens] = 1
        groups.append(np.cumsum(ends) - ends)
    return Aligned(places, a, b, overlaps, a.ends[last[:, 0]], *groups)


def pieces_of(text: str, chars: int = PIECE_CHARS) -> list[str]:
    """A text in pieces that start after a space between words, which is left out; other places do not cut it."""
    pieces, at = [], 0
    while len(text) - at > chars and (found := BETWEEN_WORDS.search(text, at + chars)):
        pieces.append(text[at:found.start()])
        at = found.end()
    return [*pieces, text[at:]]


class Aligner:
    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_ranks(vocabulary)
        self.byte_level = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.cuts = not any(MARK in p.lstrip(MARK) for p in names)  # no piece reaches into the next word
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of over {1 << ID_BITS} tokens")
        self.a_sizes = np.array([len(t) for t in self.a_bytes])
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        number = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.inside, self.a_last, self.b_last = (np.array([n + mark for n in number], dtype=object) for mark in (b",", b"|", b";"))

    def align(self, texts: list[str]) -> Aligned:
        """Of texts that are not empty; one that a side does not give back byte by byte is left out."""
        spaced = [" " + t for t in texts]
        a = [self.byte_level.encode_to_numpy(t, disallowed_special=()) for t in spaced]
        b = self.pieces.encode(texts, num_threads=1)
        raw = [t.encode() for t in spaced]
        # Byte-level tokens are stretches of the text, so their sizes tell whether any of it is left out.
        good = [k for k, want in enumerate(raw) if self.a_sizes[a[k]].sum() == len(want) and b"".join(map(self.b_bytes.__getitem__, b[k])) == want]

        def side(ids: list, flat: np.ndarray, sizes: np.ndarray) -> Side:
            text = np.repeat(np.arange(len(good)), [len(ids[k]) for k in good])
            return Side(flat, text, np.cumsum(sizes[flat]) if len(flat) else flat)

        a_ids = np.concatenate([a[k] for k in good] or [np.zeros(0)]).astype(np.int64)
        b_ids = np.fromiter(chain.from_iterable(b[k] for k in good), np.int64)
        return align_sides(np.array(good, dtype=np.int64), side(a, a_ids, self.a_sizes), side(b, b_ids, self.b_sizes))

    def listing(self, found: Aligned) -> list[bytes]:
        """Each text's groups as decimal ids: ``a1,a2|b1;a3|b2,b3``, with a last semicolon."""
        a, b, groups = found.a, found.b, np.arange(len(found.group_ends) + 1)
        first_a, first_b = np.searchsorted(found.a_group, groups), np.searchsorted(found.b_group, groups)
        out = np.empty(len(a.ids) + len(b.ids), dtype=object)
        written = self.inside[a.ids]
        written[first_a[1:] - 1] = self.a_last[a.ids[first_a[1:] - 1]]
        out[np.arange(len(a.ids)) + first_b[found.a_group]] = written
        written = self.inside[b.ids]
        written[first_b[1:] - 1] = self.b_last[b.ids[first_b[1:] - 1]]
        out[np.arange(len(b.ids)) + first_a[found.b_group + 1]] = written
        bounds = (found.text_bounds(a) + found.text_bounds(b)).tolist()
        flat = out.tolist()
        return [b"".join(flat[x:y]) for x, y in zip(bounds, bounds[1:])]


def linked_pairs(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each text, and its distinct linked id pairs with their numbers of links: (links by text, text of a pair, pair as
    one number, times), by text and pair. All tokens of a group's one side link with all of its other side."""
    groups = len(found.group_ends)
    n_a, n_b = np.bincount(found.a_group, minlength=groups), np.bincount(found.b_group, minlength=groups)
    first_b = np.cumsum(n_b) - n_b
    links = np.bincount(found.a.text, weights=n_b[found.a_group], minlength=len(found.places)).astype(np.int64)
    small = n_a * n_b <= LARGE_GROUP
    tokens = np.flatnonzero(small[found.a_group])
    of = found.a_group[tokens]
    repeat = n_b[of]
    left = np.repeat(tokens, repeat)
    within = np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    right = np.repeat(first_b[of], repeat) + within
    texts, pairs = [found.a.text[left]], [found.a.ids[left] << ID_BITS | found.b.ids[right]]
    times = [np.ones(len(left), dtype=np.int64)]
    first_a = np.cumsum(n_a) - n_a
    for g in np.flatnonzero(~small):
        a, a_times = np.unique(found.a.ids[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
        b, b_times = np.unique(found.b.ids[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
        pairs.append((a[:, None] << ID_BITS | b[None]).ravel())
        times.append((a_times[:, None] * b_times[None]).ravel())
        texts.append(np.full(len(pairs[-1]), found.a.text[first_a[g]]))
    text, pair, count = merge_pairs(np.concatenate(texts), np.concatenate(pairs), np.concatenate(times))
    return links, text, pair, count


def merge_pairs(text: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs of a text once, sorted, with their times added up."""
    # Ids have 40 bits together, so 2 ** 23 texts fit beside them.
    code = text << 2 * ID_BITS | pair
    order = np.argsort(code, kind="stable")
    code = code[order]
    head = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(times[order], head) if len(head) else head
    return code[head] >> 2 * ID_BITS, code[head] & ((1 << 2 * ID_BITS) - 1), total


def _texts(column: pa.Array) -> list[str]:
    """Null as the empty text; what is no valid UTF-8 is replaced, and so not given back byte by byte."""
    return [(raw or b"").decode(errors="replace") for raw in column.cast(pa.binary()).to_pylist()]


def _valid(column: pa.Array, texts: list[str]) -> list[bool]:
    return [bool(t) and ("�" not in t or t.encode() == raw) for t, raw in zip(texts, column.cast(pa.binary()).to_pylist())]


NOTHING = (0, 0, 0, 0, "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def _of_texts(aligner: Aligner, texts: list[str]) -> list[tuple]:
    """For each text the numbers of tokens, groups and links, the digest of its groups, its pairs and their times."""
    out: list[tuple] = [NOTHING] * len(texts)
    found = aligner.align(texts)
    links, text, pair, times = linked_pairs(found)
    at = np.searchsorted(text, np.arange(len(found.places) + 1))
    n_a, n_b, n_groups = (np.diff(x) for x in (found.text_bounds(found.a), found.text_bounds(found.b), found.group_bounds()))
    for k, (place, listed) in enumerate(zip(found.places.tolist(), aligner.listing(found))):
        span = slice(at[k], at[k + 1])
        digest = hashlib.sha256(listed[:-1]).hexdigest()
        out[place] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(links[k]), digest, pair[span], times[span])
    return out


def _of_long_text(aligner: Aligner, text: str, chars: int = PIECE_CHARS) -> tuple:
    """The same for one text, a piece at a time."""
    totals, digest = np.zeros(4, dtype=np.int64), hashlib.sha256()
    pair = times = np.zeros(0, dtype=np.int64)
    pieces = pieces_of(text, chars)
    for k, piece in enumerate(pieces):
        found = aligner.align([piece])
        if not len(found.places):
            return NOTHING
        links, _, more, more_times = linked_pairs(found)
        totals += [len(found.a.ids), len(found.b.ids), len(found.group_ends), links[0]]
        listed = aligner.listing(found)[0]
        digest.update(listed if k < len(pieces) - 1 else listed[:-1])
        pair, times = np.concatenate([pair, more]), np.concatenate([times, more_times])
        _, pair, times = merge_pairs(np.zeros(len(pair), dtype=np.int64), pair, times)
    return (*totals.tolist(), digest.hexdigest(), pair, times)


def _batches(texts: list[str], good: list[bool], longest: int) -> Iterator[list[int]]:
    """Places of texts of at most ``longest`` characters, some at a time."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if good[k] and len(text) <= longest:
            held.append(k)
            size += len(text)
            if size >= BATCH_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def aligner_of(vocabulary: str, model: bytes) -> Aligner:
    return Aligner(vocabulary, model)


def _summaries(shipped) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        aligner = kept(shipped, aligner_of)
        for batch in batches:
            texts = _texts(batch.column("text"))
            good = _valid(batch.column("text"), texts)
            longest = PIECE_CHARS if aligner.cuts else max(map(len, texts), default=0)
            todo = [*_batches(texts, good, longest), *([k] for k, t in enumerate(texts) if good[k] and len(t) > longest)]
            todo.append([k for k, is_good in enumerate(good) if not is_good])
            for places in todo:
                if not places:
                    continue
                if not good[places[0]]:
                    found = [NOTHING] * len(places)
                elif len(texts[places[0]]) > longest:
                    found = [_of_long_text(aligner, texts[places[0]])]
                else:
                    found = _of_texts(aligner, [texts[k] for k in places])
                yield from _rows(batch, places, found)

    return run


def _rows(batch: pa.RecordBatch, places: list[int], found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A row for each document; pairs beyond ``PAIRS_IN_A_ROW`` go on in further rows of it."""
    parts = [(k, start) for k, f in enumerate(found) for start in range(0, max(len(f[5]), 1), PAIRS_IN_A_ROW)]
    of = [k for k, _ in parts]
    ends = np.cumsum([0] + [len(found[k][5][s:s + PAIRS_IN_A_ROW]) for k, s in parts]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([found[k][c][s:s + PAIRS_IN_A_ROW] for k, s in parts])))
             for c in (5, 6)]
    taken = pa.array([places[k] for k in of])
    numbers = [pa.array([found[k][c] for k in of], pa.int64()) for c in range(4)]
    yield pa.RecordBatch.from_arrays(
        [batch.column("row").take(taken), pa.array([s == 0 for _, s in parts]), batch.column("doc_id").take(taken), *numbers,
         pa.array([found[k][4] for k in of], pa.string()), *lists],
        ["row", "head", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _arrays(shipped) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        aligner = kept(shipped, aligner_of)
        for batch in batches:
            texts = _texts(batch.column("text"))
            good = _valid(batch.column("text"), texts)
            out: list[dict | None] = [None] * len(texts)
            for places in _batches(texts, good, max(map(len, texts), default=0)):
                found = aligner.align([texts[k] for k in places])
                a, b, groups = found.text_bounds(found.a), found.text_bounds(found.b), found.group_bounds()
                pairs = np.searchsorted(found.overlaps[:, 0], a)
                for k, place in enumerate(found.places.tolist()):
                    start = found.a.starts[a[k]]
                    out[places[place]] = {
                        "a_ids": found.a.ids[a[k]:a[k + 1]], "a_ends": found.a.ends[a[k]:a[k + 1]] - start,
                        "b_ids": found.b.ids[b[k]:b[k + 1]], "b_ends": found.b.ends[b[k]:b[k + 1]] - start,
                        "group_ends": found.group_ends[groups[k]:groups[k + 1]] - start,
                        "overlap_a": found.overlaps[pairs[k]:pairs[k + 1], 0] - a[k],
                        "overlap_b": found.overlaps[pairs[k]:pairs[k + 1], 1] - b[k]}
            empty = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([(r[c] if r else empty) for r in out], pa.list_(pa.int64())) for c in ARRAYS]],
                ["doc_id", *ARRAYS])

    return run


ARRAYS = ["a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "overlap_a", "overlap_b"]


def _ship(spark: SparkSession, a_path: str, b_path: str):
    """Both vocabularies, whatever the input."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return ship(spark, vocabulary=a.read(), model=b.read())


def align(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and arrays: ids and ends (in bytes of the text with a space in front) of both sides' tokens, the ends that cut
    them into groups, and the numbers of overlapping tokens, side by side.

    Texts that are null or empty, or that a side does not give back byte by byte, have empty arrays. Repeated rows repeat their
    results, an empty table gives an empty result, other columns are not looked at.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} array<long>" for c in ARRAYS)
    shipped = _ship(docs.sparkSession, a_path, b_path)
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_arrays(shipped), schema)


def pair_counts(written: DataFrame) -> DataFrame:
    """``pair, n, best``: how many documents hold an id pair linked, and whether no pair of its A id is in more."""
    counts = written.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    # At most one row for every B id.
    of_a = Window.partitionBy(F.shiftright("pair", ID_BITS))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def _least_frequent_sent(counts: DataFrame, most: int) -> int:
    """The least count, a power of two, so that at most so many pairs have it or more; 1 if all may be sent."""
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect())  # 64 rows at most
    total, power = 0, max(sizes, default=0) + 1
    while power > 0 and total + sizes.get(power - 1, 0) <= most:
        power -= 1
        total += sizes.get(power, 0)
    return 1 << power


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text",
                     most_sent: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every document.

    A token links with all tokens of the other side in its group. The count of two ids is the number of documents that hold them
    linked; repeated rows are documents of their own. Texts that are null or empty, or that a side does not give back byte by
    byte, have zeros and an empty digest. An empty table gives an empty result, other columns are not looked at.

    Documents keep their distinct pairs, which are counted over the corpus. The most frequent pairs, up to ``most_sent``, go to
    all tasks; the others, none of which is in many documents, are joined by a shuffle.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = (f"row long, head boolean, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<long>, times array<long>")
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc_id"), F.col(text).alias("text"))
    written = cut(plain.mapInArrow(_summaries(_ship(docs.sparkSession, a_path, b_path)), schema))
    counts = cut(pair_counts(written))
    least = _least_frequent_sent(counts, most_sent)
    held = written.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    often = F.broadcast(counts.where(F.col("n") >= least))
    rated = held.join(often, "pair")
    if least > 1:
        seldom = held.join(often.select("pair"), "pair", "left_anti").join(counts.where(F.col("n") < least), "pair")
        rated = rated.unionByName(seldom)
    sums = rated.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"),
                                    F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    known = written.where("head").drop("pairs", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return known.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


by_value(__name__)
