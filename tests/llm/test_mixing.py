"""The mix against its own definition: targets, exact quotas, shards and reruns."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries
from ledgerloom.llm.feistel import permute
from ledgerloom.llm.mixing import deal, hypergeometric, mix, mix_documents, split_quotas
from tests.llm.cases import awkward, empty

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes, cap=3):
    """Exact targets: share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, left, open_ = {}, Fraction(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= cap * sizes[s]}
        for s in full or open_:
            target[s] = Fraction(cap * sizes[s]) if full else weight[s] * level
            left -= target[s]
        open_ -= full or set(open_)
    return target


def check(rows, docs):
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += words(r.text)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r.doc_id, words(r.text)) for r in docs)
    target, taken = water(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(target[r.source]), abs=1e-6)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= Fraction(1, 2) + Fraction(1, 10**6), s


def test_mix_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mix(docs, block_words=64, shards=5)
    rows = mixed.collect()
    check(rows, docs.collect())
    size, source = ({r.doc_id: r[c] for r in rows} for c in ("size", "source"))
    cover = defaultdict(Counter)  # how often each word is taken, by document
    shards = Counter()
    for r in deal(mixed).collect():
        assert 0 <= r["shard"] < 5
        cover[r.doc_id].update(range(r["first"], r["first"] + r["words"]))
        shards[r["shard"]] += r["words"]
    passes = defaultdict(set)
    for i, c in cover.items():
        assert max(c) < size[i]
        passes[source[i]] |= set(c.values()) | ({0} if len(c) < size[i] else set())
    assert all(max(p) - min(p) <= 1 for p in passes.values())  # full passes and a part of one more
    assert max(shards.values()) - min(shards.values()) < 64 * (3 + len(passes) * 2)
    again = mix(docs.repartition(7), block_words=64, shards=5).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op1_mix_sources(spark, SF).join(docs.select("doc_id", "source"), "doc_id")
    check(got.collect(), docs.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(mix(docs, block_words=16, shards=3).collect(), docs.collect())
    assert mix(empty(spark)).count() == 0
    assert mix_documents(empty(spark)).count() == 0
    blank = docs.where("text is null")
    assert [r.taken for r in mix(blank).collect()] == [0, 0]


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix_documents(docs, seed="x")
    assert rows.columns == docs.columns
    sizes, taken, longest = Counter(), Counter(), 0
    for r in docs.collect():
        sizes[r.source] += words(r.text)
        longest = max(longest, words(r.text))
    found = rows.collect()
    for r in found:
        taken[r.source] += words(r.text)
    target = water(sizes)
    assert all(abs(taken[s] - target[s]) <= 1024 + longest for s in sizes)
    assert max(Counter(r.doc_id for r in found).values()) <= 3


def test_long_whole_documents_meet_the_targets(spark):
    """Sums miss by at most half of the document at the edge, however many blocks the documents fill."""
    lengths = [5000 if k % 40 == 0 else 0 if k % 13 == 0 else 20 + k % 60 for k in range(320)]
    rows = [(1000 * s + k, "w " * n, f"src{s}") for s in range(6) for k, n in enumerate(lengths)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    target = water({f"src{s}": sum(lengths) for s in range(6)})
    for seed in ("mix", "x"):
        taken, copies = Counter(), Counter()
        for r in mix(docs, seed=seed, whole=True).collect():
            taken[r.source] += r.taken
            copies[r.doc_id] = len(r.pieces)
            assert r.taken == len(r.pieces) * r["size"]
        assert all(abs(taken[s] - t) <= 2500 + 1 for s, t in target.items()), (seed, taken, target)
        for s, t in target.items():
            passes = int(t // sum(lengths))
            mine = [n for i, n in copies.items() if f"src{i // 1000}" == s]
            assert set(mine) <= {passes, passes + 1}
        assert sum(taken.values()) == sum(words(r.text) for r in mix_documents(docs, seed=seed).collect())


def test_the_query_returns_the_dealt_pieces(spark):
    rows = queries.op1_mix_sources(spark, SF).collect()
    want = {r.doc_id: r.pieces for r in mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert {r.doc_id: r.pieces for r in rows} == want
    assert all(r.taken == sum(p.words for p in r.pieces or []) for r in rows)


def test_copies_stand_where_their_pieces_are_dealt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    places = defaultdict(list)
    for r in mix(docs, whole=True).collect():
        for p in r.pieces or []:
            places[p["shard"], p["order"]].append(r.doc_id)
    found = [r.doc_id for r in mix_documents(docs).collect()]
    at = 0
    for place in sorted(places):
        assert sorted(found[at:at + len(places[place])]) == sorted(places[place])
        at += len(places[place])
    assert at == len(found) and len({shard for shard, _ in places}) == 16


def test_hypergeometric_draws_follow_the_distribution(spark):
    for good, bad, draws in ((5, 7, 6), (3, 40, 20), (50, 50, 30), (4, 0, 2), (0, 9, 3), (9, 2, 10)):
        n = 2000
        cells = [F.lit(x).cast("long") for x in (good, bad, draws)]
        x = hypergeometric((F.col("id") + 0.5) / n, *cells)
        got = Counter(r.x for r in spark.range(n).select(x.alias("x")).collect())
        for k in range(max(0, draws - bad), min(good, draws) + 1):
            want = comb(good, k) * comb(bad, draws - k) / comb(good + bad, draws)
            assert abs(got[k] / n - want) < 0.002
        assert set(got) <= set(range(max(0, draws - bad), min(good, draws) + 1))


def test_quotas_are_split_exactly(spark):
    quotas = {0: 100_000, 1: 0, 2: 7, 3: 2500, 4: 1}
    frame = spark.createDataFrame(list(quotas.items()), "rank long, draws long")
    for shards in (1, 2, 7, 16):
        rows = split_quotas(frame, shards, "s").collect()
        by_rank, by_shard = Counter(), Counter()
        for r in rows:
            assert r.draws >= 0
            by_rank[r["rank"]] += r.draws
            by_shard[r["shard"]] += r.draws
        assert {k: by_rank[k] for k in quotas} == quotas
        assert len(by_shard) == shards and max(by_shard.values()) - min(by_shard.values()) <= 1


def test_permutation(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        place = permute(F.col("id"), F.lit(n).cast("long"), F.lit("k"))
        got = [r.p for r in spark.range(n).select(place.alias("p")).collect()]
        assert sorted(got) == list(range(n))
        assert n < 97 or sum(a == b for a, b in enumerate(got)) < n / 10
