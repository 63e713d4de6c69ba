"""Token alignment against a plain one that compares all tokens of a document."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
import tokenizers

from ledgerloom.llm import queries
from ledgerloom.llm.alignment import Aligner, _of_long_text, _of_texts, align, alignment_counts, byte_characters, pieces_of
from ledgerloom.llm.common import tokenizer
from tests.llm.cases import awkward, empty, table

SF = "/root/testdata/sf0.001"
A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
ODD = ["", "x", " lead and trail ", "a  b   c    d" + " " * 20, "tab\tnew\nline\r\n\x0b\x0c\x1c\x85\xa0 end", "<|endoftext|> <s> </s> <0x41>", "▁mark ▁▁ x",
       "日本語のテキスト 💩💩 é́ ﷽", "\x00zero\x00", "I'm you'll WE'RE don't", "x" * 3000, "ab" * 500 + " " + "1234567890" * 50, "½ ² Ⅻ ⅷ",
       "the the the of of the", "﻿bom ​‍", "don’t “quote”"]


def plain(texts):
    """The whole result by loops, with the libraries' own tokens."""
    a_side = tokenizers.Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B)
    stands = byte_characters()
    documents = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = [(i, bytes(stands[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = []
        for i in b_side.encode(text) if text else []:
            piece = b_side.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            a = b = []
        ends = []
        for side in (a, b):
            at, out = 0, []
            for _, t in side:
                out.append((at, at + len(t)))
                at += len(t)
            ends.append(out)
        cuts = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        groups, places = [], [0, 0]
        for cut in cuts:
            group = []
            for k, (side, ranges) in enumerate(((a, ends[0]), (b, ends[1]))):
                group.append([])
                while places[k] < len(side) and ranges[places[k]][1] <= cut:
                    group[k].append(side[places[k]][0])
                    places[k] += 1
            groups.append(tuple(group))
        overlaps = [(x, y) for x, (s, e) in enumerate(ends[0]) for y, (u, v) in enumerate(ends[1]) if s < v and u < e] if len(a) < 400 else None
        documents.append((a, b, ends, cuts, groups, overlaps))
    held = Counter(pair for *_, groups, _ in documents for pair in {(x, y) for g in groups for x in g[0] for y in g[1]})
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for a, b, _, _, groups, _ in documents:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        listed = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                     hashlib.sha256(listed.encode()).hexdigest() if a else ""))
    return rows, documents


@pytest.mark.parametrize("most_sent", [500_000, 40])
def test_counts_equal_plain_loops(spark, most_sent):
    rows = [(k, t, None, None) for k, t in enumerate([*ODD, *ODD[:6], None, "the of", "the end of the text"])]
    rows += [(None, "null id", None, None), (3, "repeated id", None, None)]
    docs = table(spark, rows).repartition(3)
    stored = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, *w) for (i, _), w in zip(stored, plain([t for _, t in stored])[0])]
    got = [tuple(r) for r in alignment_counts(docs, A, B, most_sent=most_sent).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    stored = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, *w) for (i, _), w in zip(stored, plain([t for _, t in stored])[0])]
    assert sorted(repr(tuple(r)) for r in alignment_counts(docs, A, B).collect()) == sorted(map(repr, want))
    assert alignment_counts(empty(spark), A, B).collect() == []
    assert align(empty(spark), A, B).collect() == []


def test_query_equals_plain_loops(spark):
    stored = [(r.doc_id, r.text) for r in queries.documents(spark, SF).collect()]
    want = {i: w for (i, _), w in zip(stored, plain([t for _, t in stored])[0])}
    assert {r.doc_id: tuple(r)[1:] for r in queries.op11_token_alignment(spark, SF).collect()} == want


def test_overlaps_equal_plain_loops(spark):
    docs = table(spark, [(k, t, None, None) for k, t in enumerate(ODD)])
    _, documents = plain(ODD)
    for r in align(docs, A, B).collect():
        a, b, ends, cuts, _, overlaps = documents[r.doc_id]
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b]
        assert r.a_ends == [e for _, e in ends[0]] and r.b_ends == [e for _, e in ends[1]]
        assert r.group_ends == cuts
        if overlaps is not None:
            assert list(zip(r.overlap_a, r.overlap_b)) == overlaps


def aligner():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return Aligner(a.read(), b.read())


def test_long_texts_in_pieces():
    side = aligner()
    texts = [" ".join(ODD[1:]).replace("▁", "_"), "über straße 日本 語 " * 300, "no spaces" + "x" * 500, "a b"]
    for text in texts:
        whole = _of_texts(side, [text])[0]
        for chars in (1, 7, 100):
            pieces = pieces_of(text, chars)
            assert " ".join(pieces) == text
            cut = _of_long_text(side, text, chars)
            assert cut[:5] == whole[:5]
            assert list(cut[5]) == list(whole[5]) and list(cut[6]) == list(whole[6])


def test_large_groups_by_distinct_ids(monkeypatch):
    from ledgerloom.llm import alignment

    side = aligner()
    whole = [tuple(map(repr, r)) for r in _of_texts(side, ODD[1:])]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 2)
    assert [tuple(map(repr, r)) for r in _of_texts(side, ODD[1:])] == whole
