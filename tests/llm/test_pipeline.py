"""Every stage of the pipeline against plain Python, each on its own input."""

from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import sentencepiece

import corpus_pipeline
from ledgerloom.llm.common import tokenizer
from tests.llm.cases import awkward, empty
from tests.llm.test_ids import fold, reach, simhash
from tests.llm.test_mixing import water, words

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before and after each stage, with empty and letterless documents added to the table."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    more = [(9000, None, "en", "src1", None), (9001, "", None, None, 0), (9002, "12 -- 7!", "en", "src2", 8), (9003, "Été", None, None, 3)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    found = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert docs.columns == COLUMNS
        found.append(docs.collect())
    return found


def test_language_stage_drops_what_has_no_letter(steps):
    before, after = steps[0], steps[1]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if any(c.isalpha() for c in r.text or ""))


def test_exact_stage_keeps_the_largest_id(steps):
    groups = defaultdict(list)
    for r in steps[1]:
        groups[fold(r.text)].append(r.doc_id)
    assert sorted(r.doc_id for r in steps[2]) == sorted(max(g) for g in groups.values())
    assert len(steps[2]) < len(steps[1])


def test_near_stage_keeps_the_smallest_id(steps):
    rows = steps[2]
    least = defaultdict(list)
    for r, root in zip(rows, reach([simhash(r.text, 3) for r in rows], 2)):
        least[root].append(r.doc_id)
    assert sorted(r.doc_id for r in steps[3]) == sorted(min(g) for g in least.values())


def test_mix_stage_nears_its_targets(steps):
    sizes, taken, longest = Counter(), Counter(), 0
    text = {r.doc_id: r.text for r in steps[3]}
    for r in steps[3]:
        sizes[r.source] += words(r.text)
        longest = max(longest, words(r.text))
    for r in steps[4]:
        assert r.text == text[r.doc_id]
        taken[r.source] += words(r.text)
    target = water(sizes)
    assert all(abs(taken[s] - target[s]) <= Fraction(1024 + longest) for s in sizes)
    assert max(Counter(r.doc_id for r in steps[4]).values()) <= 3


def test_last_stage_encodes(steps):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = [(r.doc_id, r.lang, r.source, library.encode(r.text)) for r in steps[4]]
    assert sorted(map(repr, ((r.doc_id, r.lang, r.source, list(r.ids)) for r in steps[5]))) == sorted(map(repr, want))
    assert all(r.n_tokens == len(r.ids) and r.round_trip for r in steps[5])


def test_stages_survive_awkward_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"]
    assert rows.count() > 100
