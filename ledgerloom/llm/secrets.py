"""Secret scan: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two first-order models, of random strings and of ordinary words and names, are counted from labelled samples: what the
fixed patterns find is random; words, joined words and numbers of the same documents are ordinary. A run of token characters is a secret if
the logarithm of the two models' likelihood ratio exceeds two thresholds, in all and per character.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import array_udf, by_value

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a match's run goes on to its end, so the least length can be asked for at once
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}")
# Labels a run as ordinary: words joined by signs, or a number. Runs of other shapes have no label.
ORDINARY = re.compile(r"[A-Za-z]+(?:[_-][A-Za-z]+)*|[0-9]+")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "random")

# The models are fitted on about so many documents, picked by a hash of their text.
SAMPLE_DOCS = 20_000
LEAST = 16  # characters of a run that the models judge
ODDS = 14.0  # log-likelihood ratio that a secret exceeds,
LEAN = 1.5  # also per character
LENT = 10.0  # observations that the single characters' frequencies count as, for each first character

Span = tuple[int, int, int]  # start, kind, end: sorts by start, then kind as listed


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _codes(run: str) -> np.ndarray:
    """Characters by their place in the alphabet; the last place stands for the edge before and after a run."""
    return _PLACE[np.frombuffer(f" {run} ".encode(), dtype=np.uint8)]


_PLACE = np.full(256, len(ALPHABET))
_PLACE[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(len(ALPHABET))
STATES = len(ALPHABET) + 1


def _free(text: str, spans: list[Span], least: int) -> Iterator[re.Match]:
    """Runs of at least so many characters that touch no span; spans are sorted."""
    ends, k = sorted((s, e) for s, _, e in spans), 0
    for m in RUN.finditer(text):
        if m.end() - m.start() < least:
            continue
        while k < len(ends) and ends[k][1] <= m.start():
            k += 1
        if not any(s < m.end() and e > m.start() for s, e in ends[k:k + 8]):
            yield m


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transitions of random strings (0) and ordinary runs (1)."""
    counts = np.zeros((2, STATES * STATES), dtype=np.int64)

    def add(label: int, run: str) -> None:
        codes = _codes(run)
        np.add.at(counts[label], codes[:-1] * STATES + codes[1:], 1)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            for start, kind, end in spans:
                found = text[start:end]
                add(0, ASSIGN.match(found)[2].replace(".", "") if kind == 0 else found)
            for m in _free(text or "", spans, 6):
                if ORDINARY.fullmatch(m[0]):
                    add(1, m[0])
    label, step = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int64()), pa.array(step, pa.int64()), pa.array(counts[label, step], pa.int64())], ["label", "step", "n"]
    )


def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """The log-likelihood ratio of every transition, from a sample of about ``sample_docs`` distinct texts."""
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # Copies count once, or a group of them could be most of the sample.
    total, parts = hashed.agg(F.approx_count_distinct("hash")).first()[0], 1_000_003
    share = min(parts, -(-parts * sample_docs // max(total, 1)))
    sample = hashed.where(F.pmod("hash", F.lit(parts)) < share).dropDuplicates(["hash"]).select("text")
    counted = sample.mapInArrow(_count, "label long, step long, n long").groupBy("label", "step").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, STATES * STATES))
    for r in counted.collect():  # at most two entries for each pair of characters
        counts[r.label, r.step] += r.n
    counts = counts.reshape(2, STATES, STATES)
    # Rare transitions lean on how often the second character comes at all; without samples all ratios are even.
    single = counts.sum(axis=1) + 0.5
    single /= single.sum(axis=1, keepdims=True)
    model = np.log((counts + LENT * single[:, None, :]) / (counts.sum(axis=2, keepdims=True) + LENT))
    return (model[0] - model[1]).reshape(-1)


def scan(text: str, ratio: np.ndarray, odds: float = ODDS, lean: float = LEAN) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed patterns, and all spans."""
    base = base_spans(text)
    more = []
    for m in _free(text, base, LEAST):
        codes = _codes(m[0])
        if ratio[codes[:-1] * STATES + codes[1:]].sum() > max(odds, lean * len(m[0])):
            more.append((m.start(), 3, m.end()))
    return base, sorted(base + more)


def _join(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = "struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string>"


def find_secrets(text: Column, ratio: np.ndarray) -> Column:
    """Counts, digest and spans of a text's secrets; see ``scan_documents``."""

    def make():
        def of(texts: pa.Array) -> pa.Array:
            rows = []
            for t in texts.to_pylist():
                base, every = scan(t or "", ratio)
                kinds = [kind for _, kind, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(_join(base).encode()).hexdigest(), _join(every)))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            columns = zip(*rows) if rows else [()] * 5
            return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        return of

    return array_udf(make, FOUND)(text)


def scan_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every document.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, joined by commas; ``spans`` adds to
    the fixed patterns' spans those of kind ``random`` that the models find outside them. A null text counts as empty and
    has no spans. Repeated rows repeat their results, an empty table gives an empty result, other columns are not looked at.
    """
    ratio = fit(docs, text, sample_docs)
    return docs.select(F.col(id).alias("doc_id"), find_secrets(F.col(text), ratio).alias("s")).select("doc_id", "s.*")


by_value(__name__)
