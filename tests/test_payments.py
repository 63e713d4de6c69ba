import random
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from ledgerloom.operators import payments
from ledgerloom.operators.payments import accept_in_order, accept_within_cap, mark_first, reach, room_table

SCHEMA = "k string, seq long, amount decimal(37,12), cap decimal(37,12)"


def accepted(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = accept_within_cap(df, ["k"], "seq", "amount", "cap", "ok", **sizes)
    assert out.columns == ["k", "seq", "amount", "cap", "ok"]
    collected = out.collect()
    assert len(collected) == len(rows)
    return {r.seq: r.ok for r in collected}


def one_by_one(rows):
    paid, flags = {}, {}
    for k, seq, amount, cap in sorted(rows, key=lambda r: r[1]):
        flags[seq] = paid.get(k, 0) + amount <= cap
        if flags[seq]:
            paid[k] = paid.get(k, 0) + amount
    return flags


@pytest.mark.parametrize(("cap", "amounts", "flags"), [
    (900, [410, 420, 150, 600, 60], [True, True, False, False, True]),
    (100, [80, -30, 50, 1], [True, True, True, False]),
    (0, [0, 1], [True, False]),
    (490, [490, 490], [True, False]),
    (-5, [1, -3, -6, 1, 1], [False, False, True, True, False]),
])
@pytest.mark.parametrize("fold_rows", [4096, 0])
def test_worked_groups(spark, cap, amounts, flags, fold_rows):
    rows = [("x", i, Decimal(a), Decimal(cap)) for i, a in enumerate(amounts)]
    got = accepted(spark, rows, fold_rows=fold_rows, chunk_rows=2)
    assert [got[i] for i in range(len(amounts))] == flags


def random_rows(seed, size):
    """A third of the rows belong to one key, some amounts are negative, many are equal."""
    rng = random.Random(seed)
    caps = {f"k{i}": Decimal(rng.randint(0, 5000)) / 100 for i in range(60)}
    caps |= {"hot": Decimal(20_000), "warm": Decimal(9_999), "below": Decimal(-3)}
    rows = []
    for seq in range(size):
        draw = rng.random()
        key = "hot" if draw < 0.33 else "warm" if draw < 0.5 else "below" if draw < 0.52 else f"k{rng.randint(0, 59)}"
        cents = rng.choice([rng.randint(1, 3), rng.randint(-300, 2000), rng.randint(0, 40_000), 0])
        amount = Decimal(abs(cents) if key == "hot" else cents) / 100
        rows.append((key, seq, amount, caps[key]))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"fold_rows": 10, "chunk_rows": 250}, {"fold_rows": 500, "chunk_rows": 100, "small": False}])
def test_equals_a_sequential_loop(spark, sizes):
    rows = random_rows(5, 4000)
    assert accepted(spark, rows, **sizes) == one_by_one(rows)


def test_long_groups_with_large_and_fine_amounts(spark):
    rng = random.Random(9)
    rows = [("big", i, Decimal(rng.randint(1, 10**27)).scaleb(-12), Decimal(10**17)) for i in range(900)]
    assert accepted(spark, rows, fold_rows=0, chunk_rows=100) == one_by_one(rows)


def test_loop_helper():
    assert accept_in_order([5, 3, 2], 7) == ([True, False, True], 0)


@pytest.mark.parametrize("small", [None, False])
def test_first_of_equal_keys(spark, small):
    rows = [("a", Decimal("10.0"), 3), ("a", Decimal("10.00"), 1), ("a", Decimal("11"), 2), ("b", Decimal("10"), 0)]
    rows += [("hot", Decimal(1), 100 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, amount decimal(37,12), seq int")
    first = mark_first(df, ["k", "amount"], "seq", "first", small).filter("first")
    assert sorted(r.seq for r in first.collect()) == [0, 1, 2, 100]


def test_whole_groups_do_not_lose_columns(spark):
    df = spark.createDataFrame([("x", 1, Decimal(1), Decimal(9))], SCHEMA).withColumn("note", F.lit("n"))
    assert accept_within_cap(df, ["k"], "seq", "amount", "cap", "ok").collect()[0].note == "n"


@pytest.mark.parametrize("chunks", [16, 64])
def test_refunds_in_every_chunk_take_few_rounds(spark, chunks):
    """Amounts that cross the room's bit length again and again open every chunk."""
    size = 2048
    rows = [("x", i, Decimal(300 if i % 2 == 0 else -300), Decimal(512)) for i in range(size)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"refunds-{chunks}", "")
    try:
        assert accepted(spark, rows, fold_rows=0, chunk_rows=size // chunks) == one_by_one(rows)
        jobs = len(tracker.getJobIdsForGroup(f"refunds-{chunks}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 60  # however many chunks


@pytest.mark.parametrize("unit", [1, 10**30])
@pytest.mark.parametrize("seed", range(30))
def test_room_tables_equal_a_loop(seed, unit):
    rng = random.Random(seed)
    low, high = -rng.randint(0, 20) * unit, rng.randint(0, 300) * unit
    amounts = [rng.choice([rng.randint(-60, 60), rng.randint(0, 200), 0, 25, -25]) * unit for _ in range(rng.randint(0, 40))]
    starts, shifts = room_table(amounts, low, high)
    least, largest = reach(amounts, low, high)
    assert starts[0] == low and starts == sorted(set(starts))
    for room in range(low, high + 1, unit):
        after = accept_in_order(amounts, room)[1]
        assert room + shifts[bisect_right(starts, room) - 1] == after
        assert least <= after <= largest


def test_a_table_of_too_many_stretches_is_not_kept():
    amounts = [64, 32, 16, 8, 4, 2, 1]
    assert room_table(amounts, 0, 127, most=4) is None
    assert room_table(amounts, 0, 127) == ([*range(0, 128)], [-r for r in range(128)])


def most_rows_walked(spark, monkeypatch, rows, **sizes):
    """Most rows that one walk of a key goes through, and whether the flags are right."""
    walked = spark.sparkContext.accumulator([], payments_longest)
    plain = payments._walk

    def counting(batches):
        seen = {}

        def counted():
            for batch in batches:
                for key in batch["_key"]:
                    seen[key] = seen.get(key, 0) + 1
                yield batch

        yield from plain(counted())
        walked.add(list(seen.values()))

    monkeypatch.setattr(payments, "_walk", counting)
    assert accepted(spark, rows, **sizes) == one_by_one(rows)
    return max(walked.value)


class Longest(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, a, b):
        return [max([0, *a, *b])]


payments_longest = Longest()


def refunds_everywhere(size):
    return [("x", i, Decimal(300 if i % 2 == 0 else -300), Decimal(512)) for i in range(size)]


def test_no_walk_is_longer_than_two_chunks(spark, monkeypatch):
    """All of 64 chunks are open, and the room before each one follows from tables. Chunks come from a sampled range
    partitioning, so that one may have half as many rows again."""
    assert most_rows_walked(spark, monkeypatch, refunds_everywhere(2048), fold_rows=0, chunk_rows=32) <= 2 * 33 + 32


@pytest.mark.parametrize("seed", [1, 2])
def test_refunds_of_all_sizes(spark, monkeypatch, seed):
    rng = random.Random(seed)
    caps = {"a": Decimal(900), "b": Decimal(-4), "c": Decimal(0)}
    rows = []
    for i in range(1500):
        k = rng.choice("aaabc")
        rows.append((k, i, Decimal(rng.choice([rng.randint(-700, 700), rng.randint(-30, 60), 512, -512])), caps[k]))
    assert most_rows_walked(spark, monkeypatch, rows, fold_rows=0, chunk_rows=50) <= 200


@pytest.mark.parametrize("most", [0, 2])
def test_chunks_without_a_table_are_walked(spark, monkeypatch, most):
    monkeypatch.setattr(payments, "STRETCHES", most)
    monkeypatch.setattr(payments.room_table, "__defaults__", (most,))
    rows = refunds_everywhere(600)
    assert accepted(spark, rows, fold_rows=0, chunk_rows=30) == one_by_one(rows)


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_rows_meet_their_firsts_by_one_shuffle(spark, hot_rows):
    """Not by one for the first rows and one more for all rows."""
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', 'k' || id % 900) AS k", "cast(id AS int) AS seq").where("k <> 'k1' OR seq > 1")
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k string, seq int"))
    marked = mark_first(rows, ["k"], "seq", "first", False, hot_rows)
    got = marked.where("first AND k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.min("seq").alias("s"))
    want = {r.k: r.s for r in rows.dropna().groupBy("k").agg(F.min("seq").alias("s")).collect()}
    assert {r.k: r.s for r in got.collect()} == want and got.where("n > 1").count() == 0
    assert marked.count() == rows.count() and marked.where("k IS NULL AND first").count() == 2
    if hot_rows > 4000:
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
