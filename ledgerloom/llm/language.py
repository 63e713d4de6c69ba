"""Language identification with unigram models that sum over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. The likelihood of a word is the sum over all
ways to cut it into pieces, which a forward pass works out; a text's likelihood is the product over its words. The
probabilities come from labelled documents by expectation maximisation over the same segmentations.

Words are taken between white space, lower-cased, with the vocabulary's space mark in front, as UTF-8 bytes; a byte that is
no piece itself counts as its byte piece, so that every word has a segmentation. A long word is cut where no piece of the
vocabulary reaches across, which changes no sum; parts that stay longer than ``LONGEST`` bytes are summed in logarithms.
"""

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import asdict
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import array_udf, by_value, kept, ship
from ledgerloom.llm.piece_bpe import BYTE, MARK, NORMAL, Vocabulary, read_model
from ledgerloom.session import cut

# Distinct labelled texts per language, about, that the models are fitted on; a hash of the text picks them.
SAMPLE_DOCS = 1_000
STEPS = 2  # of expectation maximisation
UNSEEN = 0.1  # what a piece counts at least
FLOOR = 1e-8  # least probability; the product over LONGEST bytes is still a positive number
LONGEST = 32  # bytes of the words whose probabilities are summed as they are
CELLS = 1 << 19  # words times bytes that are summed at a time
MAX_WORDS = 200_000  # results of words that a worker keeps
MAX_CHARS = 4 << 20  # characters of these words
LETTER = r"\p{L}"
UNDETERMINED = "und"
LEARNING_FOLDS = 5


def words(text: str) -> list[str]:
    return text.lower().split()


def parts(word: str, joined: set[str]) -> list[bytes]:
    """A word whole, or, if it is long, cut between characters that stand side by side in no piece."""
    word = MARK + word
    raw = word.encode()
    if len(raw) <= LONGEST:
        return [raw]
    out, start = [], 0
    for at in range(1, len(word)):
        if at - start >= LONGEST // 4 and word[at - 1:at + 1] not in joined:
            out.append(word[start:at].encode())
            start = at
    return [*out, word[start:].encode()]


def joined_characters(vocabulary: Vocabulary) -> set[str]:
    """Every two characters that some piece has side by side."""
    return {p[k:k + 2] for p, kind in zip(vocabulary.pieces, vocabulary.kinds) if kind == NORMAL for k in range(len(p) - 1)}


def in_portions(rows: list, size: Callable[[tuple], int]) -> Iterator[tuple[list, bool]]:
    """Rows, longest first, by so many that their table has about ``CELLS`` cells; and whether they are long."""
    at = 0
    while at < len(rows):
        longest = size(rows[at])
        stop = at + max(1, CELLS // max(longest, 1))
        if longest > LONGEST:
            while stop > at + 1 and size(rows[min(stop, len(rows)) - 1]) <= LONGEST:
                stop = at + max(1, (min(stop, len(rows)) - at) // 2)  # words that are not long are summed as they are
        yield rows[at:stop], longest > LONGEST
        at = stop


class Pieces:
    """The vocabulary as a tree of bytes, looked up for many words at a time."""

    def __init__(self, vocabulary: Vocabulary):
        tree: dict[int, int] = {}
        ends = {}
        for i, (piece, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)):
            if kind not in (NORMAL, BYTE):
                continue
            raw = piece.encode() if kind == NORMAL else bytes([int(piece[3:5], 16)])
            node = 0
            for b in raw:
                node = tree.setdefault(node << 8 | b, len(tree) + 1)
            if kind == NORMAL or node not in ends:
                ends[node] = i
        self.size = len(vocabulary.pieces)
        self.keys = np.array(sorted(tree), dtype=np.int64)
        self.nodes = np.array([tree[k] for k in self.keys.tolist()], dtype=np.int64)
        self.piece = np.full(len(tree) + 1, -1)
        self.piece[list(ends)] = list(ends.values())

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``start, end, rows, pieces`` by ascending start: which words have which piece there. Words come longest first."""
        lengths = np.array([len(w) for w in words])
        grid = np.zeros((len(words), lengths.max(initial=0)), dtype=np.int64)
        for k, w in enumerate(words):
            grid[k, :len(w)] = np.frombuffer(w, dtype=np.uint8)
        for start in range(grid.shape[1]):
            rows = np.arange(np.count_nonzero(lengths > start))
            node = np.zeros(len(rows), dtype=np.int64)
            end = start
            while len(rows):
                key = node << 8 | grid[rows, end]
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                there = self.keys[at] == key
                rows, node, end = rows[there], self.nodes[at[there]], end + 1
                piece = self.piece[node]
                whole = piece >= 0
                if whole.any():
                    yield start, end, rows[whole], piece[whole]
                longer = lengths[rows] > end
                rows, node = rows[longer], node[longer]


class Model:
    """Piece probabilities of every language: an array of pieces by languages."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], probability: np.ndarray):
        self.vocabulary, self.languages, self.probability = vocabulary, languages, probability

    @cached_property
    def pieces(self) -> Pieces:
        return Pieces(self.vocabulary)

    @cached_property
    def joined(self) -> set[str]:
        return joined_characters(self.vocabulary)

    def log_likelihoods(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood of every word (rows, longest first) under every language."""
        out = [self._sums(some, is_long) for some, is_long in in_portions(words, len)]
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def _sums(self, words: list[bytes], is_long: bool) -> np.ndarray:
        forward = np.full((len(words[0]) + 1, len(words), len(self.languages)), -np.inf if is_long else 0.0)
        forward[0] = 0.0 if is_long else 1.0
        probability = np.log(self.probability) if is_long else self.probability
        for start, end, rows, piece in self.pieces.matches(words):
            if is_long:
                forward[end, rows] = np.logaddexp(forward[end, rows], forward[start, rows] + probability[piece])
            else:
                forward[end, rows] += forward[start, rows] * probability[piece]
        sums = forward[[len(w) for w in words], np.arange(len(words))]
        return sums if is_long else np.log(sums)

    def expected(self, words: list[bytes], language: np.ndarray, count: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words (longest first) of each language: pieces by languages."""
        found = np.zeros(self.probability.shape)
        at = 0
        for some, _ in in_portions(words, len):
            here = slice(at, at + len(some))
            self._expect(some, language[here], count[here], found)
            at += len(some)
        return found

    def _expect(self, words: list[bytes], language: np.ndarray, count: np.ndarray, found: np.ndarray) -> None:
        logs = np.log(self.probability)
        steps = [(s, e, rows, piece, logs[piece, language[rows]]) for s, e, rows, piece in self.pieces.matches(words)]
        forward = np.full((len(words[0]) + 1, len(words)), -np.inf)
        backward = forward.copy()
        lengths, every = [len(w) for w in words], np.arange(len(words))
        forward[0] = 0.0
        for start, end, rows, _, p in steps:
            forward[end, rows] = np.logaddexp(forward[end, rows], forward[start, rows] + p)
        backward[lengths, every] = 0.0
        for start, end, rows, _, p in reversed(steps):
            backward[start, rows] = np.logaddexp(backward[start, rows], p + backward[end, rows])
        total = forward[lengths, every]
        for start, end, rows, piece, p in steps:
            share = count[rows] * np.exp(forward[start, rows] + p + backward[end, rows] - total[rows])
            np.add.at(found, (piece, language[rows]), share)


class Scorer:
    """Scores texts; keeps the log-likelihoods of the words it met lately."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.chars = 0
        self.table = np.zeros((0, len(model.languages)))

    def learn(self, fresh: set[str]) -> None:
        joined = self.model.joined
        cut_up = [(k, part) for k, w in enumerate(fresh) for part in parts(w, joined)]
        cut_up.sort(key=lambda x: -len(x[1]))
        more = np.zeros((len(fresh), len(self.model.languages)))
        np.add.at(more, [k for k, _ in cut_up], self.model.log_likelihoods([part for _, part in cut_up]))
        self.known.update({w: k for k, w in enumerate(fresh, len(self.known))})
        self.chars += sum(map(len, fresh))
        self.table = np.concatenate([self.table, more])

    def total(self, found: list[str]) -> np.ndarray:
        """The log-likelihood of words under every language."""
        sums = np.zeros(len(self.model.languages))
        for k in range(0, len(found), MAX_WORDS // 4):
            some = found[k:k + MAX_WORDS // 4]
            try:
                rows = [self.known[w] for w in some]
            except KeyError:
                if len(self.known) > MAX_WORDS or self.chars > MAX_CHARS:
                    self.known, self.chars, self.table = {}, 0, np.zeros_like(self.table[:0])
                self.learn({w for w in some if w not in self.known})
                rows = [self.known[w] for w in some]
            sums += self.table[rows].sum(axis=0)
        return sums

    def score_all(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """The language of each text and its posterior probability, all languages being equally likely beforehand. A null text
        is undetermined."""
        for k in range(0, len(texts), 200):
            found = [words(t) if t else [] for t in texts[k:k + 200]]
            self.total([w for some in found for w in some])  # the words of many texts are learned at once
            for some in found:
                if not some or not self.model.languages:
                    yield UNDETERMINED, 0.0
                    continue
                total = self.total(some)
                best = int(total.argmax())
                yield self.model.languages[best], round(float(1 / np.exp(total - total[best]).sum()), 6)


def model_of(vocabulary: dict, languages: list[str], probability: np.ndarray, **_) -> Model:
    return Model(Vocabulary(**vocabulary), languages, probability)


def scorer_of(**model) -> Scorer:
    return Scorer(model_of(**model))


def shipped_model(spark, model: Model):
    """Its size is that of the vocabulary times the number of languages, whatever the number of documents."""
    return ship(spark, vocabulary=asdict(model.vocabulary), languages=model.languages, probability=model.probability)


def _count_words(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = kept(model, model_of).joined
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts.update((lang, w) for w in words(text))
            cut_up: Counter = Counter()
            for (lang, w), n in counts.items():
                for part in parts(w, joined):
                    cut_up[lang, part] += n
            langs, found = zip(*cut_up) if cut_up else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.binary()), pa.array(cut_up.values(), pa.int64())], ["lang", "word", "n"]
            )

    return run


def _expect(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = kept(model, model_of)
        place = {x: k for k, x in enumerate(of.languages)}
        for batch in batches:
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns)), key=lambda r: -len(r[1]))
            found = of.expected(
                [r[1] for r in rows], np.array([place[r[0]] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=float)
            )
            piece, language = np.nonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(language, pa.int64()), pa.array(piece, pa.int64()), pa.array(found[piece, language])], ["language", "piece", "n"]
            )

    return run


def held_out(id: Column) -> Column:
    """Whether a document is kept from learning; a null id counts as an empty one, which is."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % LEARNING_FOLDS == 0


def fit(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Models of all labels that learning documents carry, from about ``sample_docs`` distinct texts of each."""
    spark = docs.sparkSession
    vocabulary = read_model(path)
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), held_out(F.col(id)).alias("held_out"))
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.col("held_out")).drop("held_out")
    labelled = labelled.withColumn("hash", F.xxhash64("text"))
    # One entry per language. Copies count once, or a group of them could be most of a sample.
    totals = {r.lang: max(r.n, 1) for r in labelled.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    languages, parts = sorted(totals), 1_000_003
    start = np.full((len(vocabulary.pieces), len(languages)), 1 / len(vocabulary.pieces))
    if not languages:
        return Model(vocabulary, [], start)
    shares = F.create_map(*[F.lit(x) for k in languages for x in (k, min(parts, -(-parts * sample_docs // totals[k])))])
    sample = labelled.where(F.pmod("hash", F.lit(parts)) < shares[F.col("lang")]).dropDuplicates(["lang", "hash"])
    model = Model(vocabulary, languages, start)
    shipped = shipped_model(spark, model)
    counted = sample.select("lang", "text").mapInArrow(_count_words(shipped), "lang string, word binary, n long")
    counted = cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(STEPS):
        shipped.destroy()
        shipped = shipped_model(spark, model)
        expected = counted.mapInArrow(_expect(shipped), "language long, piece long, n double")
        sums = expected.groupBy("language", "piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(start.shape, UNSEEN)
        counts[sums["piece"].to_numpy(), sums["language"].to_numpy()] += sums["n"].to_numpy()
        model = Model(vocabulary, languages, np.maximum(counts / counts.sum(axis=0), FLOOR))
    shipped.destroy()
    return model


def has_letter(text: Column) -> Column:
    """Whether a text has a letter in the sense of Unicode; a null text has none."""
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def predict(text: Column, model: Model, docs: DataFrame) -> Column:
    """``struct<lang_pred, score>`` of a text: ``und`` and 0 if it is null or has no letter."""
    shipped = shipped_model(docs.sparkSession, model)

    def make():
        scorer = kept(shipped, scorer_of)

        def of(texts: pa.Array) -> pa.Array:
            rows = list(scorer.score_all(texts.to_pylist()))
            langs, scores = zip(*rows) if rows else ((), ())
            return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

        return of

    return array_udf(make, "struct<lang_pred:string,score:double>")(F.when(has_letter(text), text))


def identify(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document, learned from the labelled documents that are not held out.

    A document is held out if the CRC-32 of its id as text is divisible by 5. Predictions see the text only. A null text, or
    one without a letter, is ``und`` with score 0, and so is every text if nothing can be learned. Repeated rows repeat
    their results, an empty table gives an empty result, other columns are not looked at.
    """
    model = fit(docs, path, id, text, lang)
    found = docs.select(F.col(id).alias("doc_id"), held_out(F.col(id)).alias("held_out"), predict(F.col(text), model, docs).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def drop_undetermined(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the documents that have no language, and with the language found as their ``lang``.

    A null text and one without a letter have no language. Where nothing can be learned, every text with a letter stays and keeps
    its ``lang``. Repeated rows repeat their results, an empty table gives an empty result; columns of any name come back as
    they are.
    """
    model = fit(docs, path, id, text, lang)
    if not model.languages:
        return docs.where(has_letter(F.col(text)))
    # Every text with a letter gets a language; said so, the filter needs no second look at the model.
    return docs.where(has_letter(F.col(text))).withColumn(lang, predict(F.col(text), model, docs)["lang_pred"])


by_value(__name__)
