import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins, keys
from ledgerloom.operators.inventory import apply_deltas
from ledgerloom.operators.keys import assign_by_position, assign_keys


def facts(spark):
    """One key holds most rows, one hot key has no parent, some keys are NULL."""
    rows = [("hot", i) for i in range(2000)] + [("gone", i) for i in range(900)] + [(None, i) for i in range(300)]
    rows += [(f"x{i % 40}", i) for i in range(400)]
    return spark.createDataFrame(rows, "k string, i int").repartition(6)


@pytest.mark.parametrize(("small", "hot_rows"), [(None, 100), (False, 100), (False, 10**9)])
def test_lookup_is_a_left_join(spark, small, hot_rows):
    parents = spark.createDataFrame([("hot", 1), ("x3", 2), ("x4", 3), ("unused", 4)], "pk string, v int")
    out = joins.lookup(facts(spark), parents, {"k": "pk"}, {"v": "v"}, small, hot_rows)
    assert out.columns == ["k", "i", "v"]
    got = {(r.k, r.v): r["count"] for r in out.groupBy("k", "v").count().collect()}
    assert got[("hot", 1)] == 2000 and got[("gone", None)] == 900 and got[(None, None)] == 300
    assert got[("x3", 2)] == got[("x4", 3)] == 10 and sum(got.values()) == 3600


def test_hot_keys_are_salted_in_the_join(spark):
    found = joins.hot_keys(facts(spark), ["k"], 500)
    assert sorted(found) == [("gone", 900), ("hot", 2000)]
    parents = spark.createDataFrame([("hot", 1)], "pk string, v int")
    plan = joins.lookup(facts(spark), parents, {"k": "pk"}, {"v": "v"}, False, 500)._jdf.queryExecution().toString()
    assert "_slot" in plan.split("Physical Plan")[1].split("SortMergeJoin")[1].split("\n")[0]


def test_composite_hot_keys_keep_their_types(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 2)] * 5, "s string, n long")
    assert joins.hot_keys(df, ["s", "n"], 20) == [("a", 1, 50)]


def test_flags_and_orphans_treat_null_as_unknown(spark):
    parents = spark.createDataFrame([("hot",), ("hot",), (None,)], "pk string")
    flagged = joins.flag_known(facts(spark), parents, {"k": "pk"}, "known", False, 100)
    assert flagged.count() == 3600 and flagged.filter("known").count() == 2000
    assert joins.orphans(facts(spark), parents, {"k": "pk"}).count() == 1600


def test_latest_row_of_a_key_wins(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("b", 2, "only")], "k string, o int, v string")
    assert {r.k: r.v for r in joins.latest_by_key(df, ["k"], "o", ["v"]).collect()} == {"a": "new", "b": "only"}


def test_keys_are_dense_and_in_order(spark):
    df = spark.range(5000).select(F.format_string("s%d", F.col("id") % 3).alias("source"), (F.col("id") * 7919 % 5000).alias("seq"))
    rows = assign_keys(df, "key", ["source", "seq"]).collect()
    by_order = sorted(rows, key=lambda r: (r.source, r.seq))
    assert [r.key for r in by_order] == list(range(1, 5001))


def test_keys_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, o int")
    assert assign_keys(df, "key", ["o"]).count() == 0


def sequence_frame(spark, kind):
    """70,000 rows over several bitmaps, with gaps, in no order; one source is NULL and one number negative."""
    number = (F.col("id") * 48_271 % 70_001) * 3 - 5
    position = {
        "number": number,
        "split": F.struct(F.format_string("part-%d", F.col("id") % 2).alias("file"), (F.col("id") % 3 * 1000).alias("offset"), number.alias("row")),
        "text": F.lpad(number.cast("string"), 9, "0"),
        "sparse": number * 100_000,
        "repeated": F.floor(number / 40),
    }[kind]
    source = F.when(F.col("id") % 5 > 0, F.format_string("s%d", F.col("id") % 5))
    return spark.range(1, 70_001, numPartitions=7).select(source.alias("source"), position.alias("seq"), F.col("id").alias("note"))


@pytest.mark.parametrize("broadcast", [keys.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("kind", ["number", "split", "text", "sparse"])
def test_keys_by_position_equal_sorted_keys(spark, monkeypatch, kind, broadcast):
    monkeypatch.setattr(keys, "BROADCAST_BYTES", broadcast)
    rows = sequence_frame(spark, kind)
    got = assign_by_position(rows, "key", ["source"], "seq", first=7)
    assert got.columns == ["key", "source", "seq", "note"]
    assert got.join(assign_keys(rows, "key", ["source", "seq"], first=7), ["key", "note"]).count() == 70_000


def test_positions_that_repeat_or_are_missing_still_get_keys_of_their_own(spark):
    rows = sequence_frame(spark, "repeated").withColumn("seq", F.when(F.col("note") % 9 > 0, F.col("seq")))
    got = [r.key for r in assign_by_position(rows, "key", ["source"], "seq").collect()]
    assert sorted(got) == list(range(1, 70_001))


@pytest.mark.parametrize("broadcast", [keys.BROADCAST_BYTES, 0])
def test_dense_positions_are_not_range_sorted(spark, monkeypatch, broadcast):
    monkeypatch.setattr(keys, "BROADCAST_BYTES", broadcast)
    got = assign_by_position(sequence_frame(spark, "split"), "key", ["source"], "seq")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert ("ShuffledHashJoin" in plan) == (broadcast == 0)


def test_positions_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, o int")
    assert assign_by_position(df, "key", ["a"], "o").count() == 0


def test_every_stock_row_of_a_key_changes(spark):
    stock = spark.createDataFrame([(1, 7, 1, 50), (2, 7, 1, 60), (3, 7, 2, 70)], "id int, p int, w int, qty int")
    deltas = spark.createDataFrame([(7, 1, -25), (7, 1, 15), (9, 9, 5)], "p int, w int, d int")
    got = apply_deltas(stock, deltas, ["p", "w"], "qty", "d")
    assert sorted((r.id, r.qty) for r in got.collect()) == [(1, 40), (2, 50), (3, 70)]
    assert got.schema["qty"].dataType == stock.schema["qty"].dataType


def test_parents_of_some_megabytes_are_not_broadcast(spark, tmp_path):
    """The driver would hold them as hash table, many times the size of their file."""
    spark.range(1_500_000).selectExpr("id AS k", "xxhash64(id) AS v").write.parquet(f"{tmp_path}/parents")
    parents = spark.read.parquet(f"{tmp_path}/parents")
    found = joins.lookup(spark.range(10).select(F.col("id").alias("k")), parents, {"k": "k"}, {"v": "v"})
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert not joins.fits_broadcast(parents)
    assert found.where("v IS NOT NULL").count() == 10


def test_salting_needs_only_the_columns_it_deals_by(spark):
    wide = facts(spark).selectExpr("k", "i", "concat('never ', 'asked ', i) AS wide")
    parents = spark.createDataFrame([("hot", 1), ("x3", 2)], "pk string, v int")
    found = joins.lookup(wide, parents, {"k": "pk"}, {"v": "v"}, False, 100, deal=["i"]).select("k", "i", "v")
    assert "never" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("v = 1").count() == 2000 and found.count() == 3600
