"""Encoding and decoding with a merge-type (BPE) SentencePiece model, exactly, by backtracking.

A token sequence is what the merges give when every two neighbours survive being merged anew from their characters. So a
word is covered from the left with the longest vocabulary match (Aho-Corasick finds all matches in one pass); a match that
does not fit its left neighbour, or ends where covering has failed before (a bitfield of positions), gives way to the next
shorter one, and if none is left the neighbour is taken back.

Words can be encoded alone: no piece has a space mark after another character, and a character that occurs in no longer
piece never merges. Each worker keeps the ids of short words it met lately, in two tables of a fixed size: a full one becomes
the older one, and words that come again are taken over from there.
"""

import hashlib
import re
from array import array
from dataclasses import asdict, dataclass
from operator import or_

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import array_udf, by_value, kept, ship

MARK = "▁"
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
NEVER = float("inf")
OUTSIDE = -1  # stands for a character that is no piece
NOTHING = -2
PAIR_BITS = 20
MAX_PAIRS = 300_000  # pairs whose compatibility a worker remembers
CACHED_WORD = 64  # characters of the longest words whose ids a worker remembers
CACHE_CHARS = 6 << 20  # characters and bytes of the words and ids in each of the two tables that it remembers


@dataclass
class Vocabulary:
    """Pieces with their scores and kinds, by id."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]


def read_model(path: str) -> Vocabulary:
    """Read a model file. Only what the encoder reproduces is accepted: merges, byte fallback, texts taken as they are."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    plain = not normalizer.precompiled_charsmap and normalizer.add_dummy_prefix and normalizer.escape_whitespaces
    if trainer.model_type != 2 or not trainer.byte_fallback or not plain or normalizer.remove_extra_whitespaces:
        raise ValueError(f"{path}: only merge-type models with byte fallback and an identity normalizer are supported")
    if any(p.type == USER_DEFINED for p in model.pieces):
        raise ValueError(f"{path}: user-defined symbols are not supported")
    return Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], [p.type for p in model.pieces])


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.pieces = vocabulary.pieces
        self.ids = {p: i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == NORMAL}
        self.ranks = {p: -vocabulary.scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == BYTE}
        self.values = {i: b for b, i in self.bytes.items()}
        self.numbers = [str(i) for i in range(len(self.pieces))]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans a word boundary")
        joining = {c for p in self.ids if len(p) > 1 for c in p} - {MARK}
        chars = "".join(map(re.escape, sorted(joining)))
        self.words = re.compile(f"{MARK}*[{chars}]+|{MARK}+|[^{chars}{MARK}]")
        self.matcher = ahocorasick.Automaton()
        for p, i in self.ids.items():
            # A piece that its own merges do not give never comes out of them.
            if self.merged(p) == [p]:
                self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        # Both lists end with the entry of a character outside the vocabulary.
        self.sizes = [*map(len, self.pieces), 1]
        self.shorter = [NOTHING] * len(self.sizes)
        for p in self.matcher:
            prefixes = (p[:k] for k in range(len(p) - 1, 0, -1))
            self.shorter[self.ids[p]] = next((self.ids[q] for q in prefixes if q in self.matcher), OUTSIDE if len(p) > 1 else NOTHING)
        self.raw = [bytes([self.values[i]]) if i in self.values else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.left = [i << PAIR_BITS for i in range(len(self.pieces))]
        self.fitting: set[int] = set()
        self.unfit: set[int] = set()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.room = CACHE_CHARS

    def merged(self, word: str) -> list[str]:
        """The merges themselves: always the best-scored pair, the leftmost of equals."""
        parts, rank = list(word), self.ranks.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            k = pairs.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = rank(parts[k - 1] + parts[k], NEVER)
            if k < len(pairs):
                pairs[k] = rank(parts[k] + parts[k + 1], NEVER)
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces next to each other come out of their merges as they are."""
        pair = self.left[left] | right
        if pair in self.fitting:
            return True
        if pair in self.unfit:
            return False
        if len(self.fitting) + len(self.unfit) >= MAX_PAIRS:
            self.fitting.clear()
            self.unfit.clear()
        same = self.merged(self.pieces[left] + self.pieces[right]) == [self.pieces[left], self.pieces[right]]
        (self.fitting if same else self.unfit).add(pair)
        return same

    def longest(self, word: str, at: int) -> int:
        """The longest piece that starts there."""
        for end, piece in self.matcher.iter_long(word, at):
            return piece if end + 1 - self.sizes[piece] == at else OUTSIDE
        return OUTSIDE

    def split(self, word: str) -> list[int]:
        """The ids of one word's pieces; -1 for a character outside the vocabulary."""
        # The longest matches one after the other often fit.
        sizes, found = self.sizes, [i for _, i in self.matcher.iter_long(word)]
        if sum(map(sizes.__getitem__, found)) != len(word):
            return self.backtrack(word, [], 0, self.longest(word, 0) if word else NOTHING)
        if self.fitting.issuperset(map(or_, map(self.left.__getitem__, found), found[1:])):
            return found
        at = 0
        for k in range(1, len(found)):
            at += sizes[found[k - 1]]
            if not self.fits(found[k - 1], found[k]):
                return self.backtrack(word, found[:k], at, self.shorter[found[k]])
        return found

    def backtrack(self, word: str, chosen: list[int], at: int, piece: int) -> list[int]:
        """Go on from pieces that fit: a piece that does not fit, or ends where covering has failed, gives way to the next
        shorter one; if none is left, covering fails here and the piece before gives way."""
        sizes, shorter, left, fitting = self.sizes, self.shorter, self.left, self.fitting
        failed = bytearray(len(word) // 8 + 1)  # a bit for every position
        while at < len(word):
            while piece != NOTHING:
                end = at + sizes[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not chosen or piece == OUTSIDE or (last := chosen[-1]) == OUTSIDE or left[last] | piece in fitting or self.fits(last, piece):
                        break
                piece = shorter[piece]
            if piece != NOTHING:
                chosen.append(piece)
                at = end
                piece = self.longest(word, at) if at < len(word) else NOTHING
            else:
                if not chosen:
                    raise ValueError(f"no tokens for {word!r}")
                failed[at >> 3] |= 1 << (at & 7)
                piece = chosen.pop()
                at -= sizes[piece]
                piece = shorter[piece]
        return chosen

    def encode_word(self, word: str) -> list[int]:
        found = self.split(word)
        if OUTSIDE not in found:
            return found
        ids, at = [], 0
        for i in found:
            if i == OUTSIDE:
                ids += [self.bytes[b] for b in word[at].encode()]
                at += 1
            else:
                ids.append(i)
                at += self.sizes[i]
        return ids

    def decode_raw(self, ids: list[int]) -> str:
        """Pieces and bytes put together, with the space of the first piece still there."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in self.values:
                pending.append(self.values[i])
                continue
            if pending:
                out.append(pending.decode(errors="replace"))
                pending.clear()
            out.append(self.pieces[i])
        if pending:
            out.append(pending.decode(errors="replace"))
        return "".join(out).replace(MARK, " ")

    def cut_words(self, text: str) -> list[str]:
        return self.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for word in self.cut_words(text) for i in self.encode_word(word)]

    def decode(self, ids: list[int]) -> str:
        raw = self.decode_raw(ids)
        return raw[1:] if raw.startswith(" ") else raw

    def look_up(self, word: str) -> bytes:
        """A word's ids as 32-bit numbers; long words are not kept."""
        found = self.known.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                found = array("i", self.encode_word(word)).tobytes()
            if len(word) <= CACHED_WORD:
                self.room -= len(word) + len(found)
                if self.room < 0:
                    self.older, self.known = self.known, {}
                    self.room = CACHE_CHARS
                self.known[word] = found
        return found

    def encode_cached(self, text: str) -> np.ndarray:
        words = self.cut_words(text)
        parts = list(map(self.known.get, words))
        if None in parts:
            parts = [self.look_up(word) if found is None else found for word, found in zip(words, parts)]
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def decode_whole(self, ids: list[int]) -> str:
        """The same for ids whose bytes make whole characters, as those of a text do."""
        raw = b"".join(map(self.raw.__getitem__, ids)).decode()
        return raw[1:] if raw.startswith(" ") else raw

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids, SHA-256 of the decoded text."""
        ids = self.encode_cached(text).tolist()
        written = ",".join(map(self.numbers.__getitem__, ids))
        decoded = self.decode_whole(ids)
        return len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def encoder_of(pieces: list[str], scores: list[float], kinds: list[int]) -> Encoder:
    return Encoder(Vocabulary(pieces, scores, kinds))


def _digests(vocabulary):
    encoder = kept(vocabulary, encoder_of)

    def of(texts: pa.Array) -> pa.Array:
        rows = [encoder.digest(t.as_py() or "") for t in texts]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        types = [pa.int64(), pa.string(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return of


def _round_trips(vocabulary):
    encoder = kept(vocabulary, encoder_of)

    def of(texts: pa.Array) -> pa.Array:
        found, same = [], []
        for text in texts:
            text = text.as_py() or ""
            found.append(encoder.encode_cached(text))
            same.append(encoder.decode_whole(found[-1].tolist()) == text)
        # Offsets of a list array are 32-bit; a batch of texts is far smaller.
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found or [np.zeros(0, dtype=np.int32)])))
        return pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return of


def encode_column(docs: DataFrame, path: str, text: Column) -> Column:
    """``struct<ids, round_trip>``: the token ids of a text (null: empty) without begin or end, and whether they decode to it."""
    shipped = ship(docs.sparkSession, **asdict(read_model(path)))  # one vocabulary, whatever the input
    return array_udf(lambda: _round_trips(shipped), "struct<ids:array<int>,round_trip:boolean>")(text)


def encode_digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every document.

    A null text counts as empty and gives no ids. A space mark in a text reads as a space. Repeated rows repeat their
    results, an empty table gives an empty result, other columns are not looked at.
    """
    shipped = ship(docs.sparkSession, **asdict(read_model(path)))
    digest = array_udf(lambda: _digests(shipped), "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    return docs.select(F.col(id).alias("doc_id"), digest(F.col(text)).alias("d")).select("doc_id", "d.*")


by_value(__name__)
