"""Language predictions: held-out accuracy, and what has no language."""

import math
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import queries, secrets
from ledgerloom.llm.common import tokenizer
from ledgerloom.llm.language import Model, Scorer, drop_undetermined, fit, identify, parts
from ledgerloom.llm.piece_bpe import Vocabulary
from tests.llm.cases import awkward, empty, table

SF = "/root/testdata/sf0.001"
MODEL = tokenizer("piece_bpe_32k.model")


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = identify(docs, MODEL).collect()
    texts = [r.text for r in docs.collect()]
    assert len(rows) == len(texts)
    assert sum(r.lang_pred == "und" for r in rows) == sum(not any(c.isalpha() for c in t or "") for t in texts)
    assert identify(empty(spark), MODEL).count() == 0


def segmentations(raw):
    """All ways to cut bytes into stretches."""
    if not raw:
        return [[]]
    return [[raw[:k], *rest] for k in range(1, len(raw) + 1) for rest in segmentations(raw[k:])]


def small_model(seed=1, languages=("x", "y")):
    """A model of random probabilities over a small vocabulary with all bytes, and its pieces as bytes."""
    words = ["▁a", "ab", "b", "▁ab", "ba", "aba", "日", "日本", "é", "本日本日本日本日本日本日本"]
    vocabulary = Vocabulary([*words, *(f"<0x{b:02X}>" for b in range(256))], [0.0] * (len(words) + 256), [1] * len(words) + [6] * 256)
    probability = np.random.default_rng(seed).dirichlet(np.ones(len(vocabulary.pieces)), len(languages)).T
    as_bytes = {p.encode(): i for i, p in enumerate(words)}
    for b in range(256):
        as_bytes.setdefault(bytes([b]), len(words) + b)
    return Model(vocabulary, list(languages), probability), as_bytes


def test_likelihoods_and_expectations_equal_enumeration():
    model, as_bytes = small_model()
    whole = sorted(["▁ab".encode(), "▁abab".encode(), "日本日".encode(), "aé本".encode(), b"q", b"abababababa"], key=len, reverse=True)
    language, count = np.array([k % 2 for k in range(len(whole))]), np.arange(1.0, len(whole) + 1)
    want = np.zeros(model.probability.shape)
    logs = model.log_likelihoods(whole)
    for k, raw in enumerate(whole):
        ways = [[as_bytes[s] for s in way] for way in segmentations(raw) if all(s in as_bytes for s in way)]
        for lang in range(2):
            weights = [np.prod(model.probability[way, lang]) for way in ways]
            assert np.isclose(logs[k, lang], np.log(sum(weights)))
            if lang == language[k]:
                for way, weight in zip(ways, weights):
                    np.add.at(want[:, lang], way, count[k] * weight / sum(weights))
    assert np.allclose(model.expected(whole, language, count), want)


def test_long_words_have_the_sum_of_all_segmentations():
    """Cutting where no piece reaches across, and summing in logarithms, against an unbounded forward pass."""
    model, as_bytes = small_model(2)
    for word in ("ab" * 60, "日本" * 40, "a日本b" * 20, "本日" * 30 + "zz" * 40, "é" * 50):
        raw = ("▁" + word).encode()
        want = []
        for lang in range(2):
            forward = [Fraction(1)] + [Fraction(0)] * len(raw)
            for start in range(len(raw)):
                for end in range(start + 1, min(len(raw), start + 60) + 1):
                    if raw[start:end] in as_bytes:
                        forward[end] += forward[start] * Fraction(model.probability[as_bytes[raw[start:end]], lang])
            exact = forward[-1]
            want.append(math.log(exact.numerator) - math.log(exact.denominator))
        cut = parts(word, model.joined)
        assert b"".join(cut) == raw
        assert np.allclose(Scorer(model).total([word]), want)
        assert np.allclose(model.log_likelihoods(sorted(cut, key=len, reverse=True)).sum(axis=0), want)
    assert max(map(len, parts("é" * 50, model.joined))) <= 32


def test_signs_that_are_no_letters_have_no_language(spark):
    texts = ["½ 10²", "①", "Ⅻ ⅷ", "12 -- 7!", "_", "ª", "ñ"]
    docs = table(spark, [(k, "one two three four", "en", "a") for k in range(20, 40)] + [(k, t, None, "a") for k, t in enumerate(texts)])
    rows = {r.doc_id: r for r in identify(docs, MODEL).collect()}
    assert [rows[k].lang_pred for k in range(7)] == ["und"] * 5 + ["en"] * 2
    assert [rows[k].score for k in range(5)] == [0.0] * 5
    assert {r.doc_id for r in drop_undetermined(docs, MODEL).collect()} == {5, 6, *range(20, 40)}


def test_the_language_found_goes_on(spark):
    docs = queries.documents(spark, SF)
    found = {r.doc_id: r.lang_pred for r in identify(docs, MODEL).collect()}
    rows = drop_undetermined(docs.withColumn("found", F.lit("mine")), MODEL).collect()
    assert all(r.lang == found[r.doc_id] and r.found == "mine" for r in rows) and len(rows) > 100


def test_without_labels_every_text_with_a_letter_stays(spark):
    texts = {1: "One two three", 2: None, 3: "12 -- 7!", 4: "Été", 5: "", 6: "日本"}
    unlabelled = table(spark, [(i, t, None, "a") for i, t in texts.items()])
    # Labels of held-out documents teach nothing.
    ids = [i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 5 == 0][:6]
    held = table(spark, [(i, t, "en", "a") for i, t in zip(ids, texts.values())])
    for docs in (unlabelled, held):
        rows = drop_undetermined(docs, MODEL).collect()
        assert sorted(r.text for r in rows) == sorted(["One two three", "Été", "日本"])
        assert list(rows[0].asDict()) == docs.columns


def test_copies_do_not_change_what_is_learned(spark):
    """Models of a table with many copies of some texts equal those of the table without the copies."""
    texts = [f"word{k} and word{k * k} go to place{k * 7}" for k in range(400)]
    plain = [(k, t, "en", "a") for k, t in enumerate(texts)]
    copies = [(10_000 + 400 * n + k, texts[k], "en", "a") for k in range(0, 400, 4) for n in range(30)]
    once, often = table(spark, plain), table(spark, plain + copies)
    # A text that only held-out rows have is learned if a copy of it is not held out, so compare with those rows alone.
    known = {t for i, t, _, _ in plain + copies if zlib.crc32(str(i).encode()) % 5}
    ids = [i for i in range(9_999) if zlib.crc32(str(i).encode()) % 5]
    learned = table(spark, [(i, t, "en", "a") for i, t in zip(ids, sorted(known))])
    assert np.allclose(fit(learned, MODEL).probability, fit(often, MODEL).probability)
    assert np.allclose(secrets.fit(once), secrets.fit(often))
