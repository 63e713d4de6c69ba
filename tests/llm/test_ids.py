"""Exact copies, SimHash groups and shards against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import xxhash

from ledgerloom.llm import queries
from ledgerloom.llm.components import components
from ledgerloom.llm.exact_dedup import KEY, digests, drop_exact_copies, exact_groups, merge_runs
from ledgerloom.llm.sharding import shard_documents
from ledgerloom.llm.simhash import drop_near_copies, link_fingerprints, simhash_components
from tests.llm.cases import awkward, empty, table
from tests.oracle import _rows, duck

SF = "/root/testdata/sf0.001"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, fold(r.text)) for r in docs.collect()]
    for largest in (False, True):
        groups = defaultdict(list)
        for i, t in rows:
            groups[t].append(i)
        want = []
        for i, t in rows:
            ids = [x for x in groups[t] if x is not None]
            keep = (max if largest else min)(ids) if ids else None
            want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
        got = [tuple(r) for r in exact_groups(docs, largest=largest).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    kept = drop_exact_copies(docs, largest=True)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [-9, 2, 4, 5, 6, 7, 8, 1 << 62]
    assert exact_groups(empty(spark)).count() == 0


def test_exact_rounds_merge_across_nodes(spark):
    docs = table(spark, [(i, f"text {i % 7}", None, None) for i in range(400)]).repartition(40)
    groups = merge_runs(digests(docs), largest=False, fan=2, nodes=32).collect()
    assert sorted((r.keep_id, r.group_size) for r in groups) == [(i, 58 if i == 0 else 57) for i in range(7)]
    assert set(KEY) <= set(groups[0].asDict())


def test_exact_query_equals_sql(spark):
    got = queries.op10_exact_dedup(spark, SF).toArrow()
    want = duck(SF).sql(queries.SQL["op10_exact_dedup"]).to_arrow_table()
    names = sorted(got.column_names)
    assert _rows(got.select(names)) == _rows(want.select(names))


def simhash(text, words):
    tokens = fold(text).encode().split()
    parts = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(prints, bits):
    """Smallest index that links of at most so many bits reach."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def check_components(docs, words, bits):
    rows = docs.collect()
    prints = [simhash(r.text, words) for r in rows]
    root = reach(prints, bits)
    least = defaultdict(list)
    for r, k in zip(rows, root):
        if r.doc_id is not None:
            least[k].append(r.doc_id)
    want = [(r.doc_id, f"{p:016x}", min(least[k], default=None)) for r, p, k in zip(rows, prints, root)]
    got = [tuple(r) for r in simhash_components(docs, words, bits).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_simhash_on_awkward_rows(spark):
    check_components(awkward(spark), 3, 2)
    check_components(awkward(spark), 2, 3)
    assert simhash_components(empty(spark), 3, 2).count() == 0


def test_simhash_on_documents(spark):
    check_components(spark.read.parquet(f"{SF}/documents.parquet"), 3, 2)


def test_links_connect_what_all_pairs_connect(spark):
    draw = random.Random(3)
    prints = set()
    for _ in range(60):
        x = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 12)):
            prints.add(x)
            for _ in range(draw.randrange(1, 4)):
                x ^= 1 << draw.randrange(64)
    low = draw.getrandbits(64) & ~0xFFFF  # one crowded list
    prints |= {low | draw.getrandbits(16) for _ in range(900)}
    prints = sorted(prints)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    for bits in (1, 2):
        frame = spark.createDataFrame([(signed[p],) for p in prints], "fingerprint long")
        roots = {r.node: r.root for r in components(link_fingerprints(frame, bits)).collect()}
        got, want = defaultdict(set), defaultdict(set)
        for p, k in zip(prints, reach(prints, bits)):
            got[roots.get(signed[p], signed[p])].add(p)
            want[k].add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 500, 501: 500}
    assert components(links.limit(0)).count() == 0


def check_shards(docs, rows, shards):
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in docs) == texts
    slots = defaultdict(list)
    for r in docs:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1


def test_shards(spark):
    for docs, shards in ((awkward(spark), 4), (spark.read.parquet(f"{SF}/documents.parquet"), 24), (empty(spark), 3)):
        first = shard_documents(docs, shards).collect()
        check_shards(first, docs.collect(), shards)
        again = shard_documents(docs.repartition(5), shards).collect()
        assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_shards_are_shuffled(spark):
    rows = sorted(shard_documents(spark.read.parquet(f"{SF}/documents.parquet"), 24).collect(), key=lambda r: r.doc_id)
    places = [r.shard + 24 * r.slot for r in rows]
    assert places != sorted(places) and sum(abs(p - i) > 20 for i, p in enumerate(places)) > len(rows) / 2


def test_near_copies_without_ids_or_under_one_id(spark):
    """A component keeps one row, whatever its ids."""
    near = "lorem ipsum dolor sit amet consectetur " * 30
    other = " ".join(f"w{k * k}" for k in range(200))
    third = " ".join(f"v{k * 7}" for k in range(200))
    rows = [
        (None, near, None, "a"), (None, near.upper(), None, "a"), (None, near + " ", None, "b"), (None, near, None, "a"),  # all null
        (None, other, None, "a"), (5, other + "  ", None, "a"),  # a null id beside a known one
        (7, third, None, "a"), (7, third.upper(), None, "a"), (3, "one two three four", None, "a"), (7, "five six seven eight", None, "a"),
        (None, "nine ten eleven twelve", None, "a"),
    ]
    found = [(r.doc_id, fold(r.text).strip()) for r in drop_near_copies(table(spark, rows), words=3, max_bits=2).collect()]
    want = [(None, near.strip()), (5, other), (7, third), (3, "one two three four"), (7, "five six seven eight"), (None, "nine ten eleven twelve")]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
