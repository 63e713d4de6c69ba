"""Splittable records, inferred column types, and tagged key sets."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cleaning import DAY_FIRST_DATE, ISO_DATE
from ledgerloom.operators import keysets as k
from ledgerloom.operators import profiling as p
from ledgerloom.operators.profiling import DATE, DAY_FIRST_SHAPE, ISO_SHAPE, repeated_rows, value_type
from ledgerloom.plans import profile as job
from ledgerloom.session import cut
from ledgerloom.sources import records
from ledgerloom.sources.records import parsed, read_records
from workload.raw_extracts import RawExtracts

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abcd"])


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def of(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")

    yield of
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def random_rows(seed, count=300):
    draw = random.Random(seed)
    parts = ["a", "b", " ", "é", ",", '"', "\n", "\r\n", '""', "x"]

    def value():
        if draw.random() < 0.5:
            return "".join(draw.choice("abc xyz8") for _ in range(draw.randrange(1, 6)))
        return "".join(draw.choice(parts) for _ in range(draw.randrange(9)))

    rows = [[value() for _ in range(4)] for _ in range(count)]
    rows[7][1] = "line\n" * 60  # longer than a split
    rows[8][3] = 'he said "no"\n'
    return rows


@pytest.mark.parametrize("quoting, end", [(csv.QUOTE_MINIMAL, "\n"), (csv.QUOTE_ALL, "\n"), (csv.QUOTE_MINIMAL, "\r\n")])
@pytest.mark.parametrize("size", [70, 1000, 1 << 20])
def test_records_cross_splits(spark, tmp_path, small_splits, quoting, end, size):
    for n in range(2):
        text = io.StringIO()
        writer = csv.writer(text, quoting=quoting, lineterminator=end)
        writer.writerow("abcd")
        writer.writerows(random_rows(n))
        (tmp_path / f"{n}.csv").write_text(text.getvalue(), newline="")
    small_splits(size)
    assert size > 70 or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    rows = parsed(read_records(spark, str(tmp_path)), SCHEMA).orderBy("file", "offset", "row").collect()
    assert [[v or "" for v in r["values"]] for r in rows] == [*random_rows(0), *random_rows(1)]


def test_lines_are_not_shuffled_to_learn_their_state(spark, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text('a,b,c,d\n1,"x\ny",2,3\n4,5,6,7\n')
    plans = []
    monkeypatch.setattr(records, "cut", lambda df, *a, **k: plans.append(df._jdf.queryExecution().toString()) or cut(df, *a, **k))
    assert read_records(spark, str(tmp_path)).count() == 2
    assert "Window" not in plans[0] and "Exchange" not in plans[0]


def test_quotes_inside_plain_values_and_blank_lines(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text('"a",b,c,d\n1,27" wide,"x\ny",\n\n   \n2,,"p ""q"" \n\nr","s"\n"unclosed",1,2,3\n')
    for size in (10, 1 << 20):
        small_splits(size)
        rows = parsed(read_records(spark, str(tmp_path)), SCHEMA).orderBy("offset", "row").collect()
        got = [tuple(v or "" for v in r["values"]) for r in rows]
        assert got == [("1", '27" wide', "x\ny", ""), ("2", "", 'p "q" \n\nr', "s"), ("unclosed", "1", "2", "3")]


def test_only_a_header_and_empty_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c,d\n")
    assert read_records(spark, str(tmp_path)).collect() == []
    (tmp_path / "x.csv").write_text("")
    assert read_records(spark, str(tmp_path)).collect() == []


def test_other_encodings_and_lengths(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('a,b,c,d\nñ,"ü\né",3,4\n'.encode("latin-1"))
    rows = parsed(read_records(spark, str(tmp_path), "ISO-8859-1"), SCHEMA).collect()
    assert [tuple(r["values"]) for r in rows] == [("ñ", "ü\né", "3", "4")]
    (tmp_path / "x.csv").write_text('a,b,c,d\n1,"2\n2",3\n')
    with pytest.raises(Exception, match="MALFORMED"):
        parsed(read_records(spark, str(tmp_path)), SCHEMA).collect()


@pytest.mark.parametrize("values, name", [
    ([], "nothing"), (["", "NULL", None, "n/a"], "nothing"), (["1", " -2 ", ""], "whole"), (["1", "2.5", "1e3"], "decimal"), ([".5", "1."], "decimal"),
    (["true", "False"], "bool"), (["true", "1"], "text"), (["2024-02-29", "1/2/2023"], "date"), (["2023-02-29"], "text"), (["2024-01-01", "1"], "text"),
    (["1,5"], "text"), (["$1"], "text"), ([" "], "text"), (["1", "x"], "text")])
def test_column_types_join_in_the_lattice(spark, values, name):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    known = sum(v not in (None, "", "NULL", "n/a") for v in values)
    assert [tuple(r) for r in p.column_types(df).collect()] == [("v", name, known, len(values) - known)]


def test_key_sets_answer_orphans_overlaps_and_repeats(spark):
    parents = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    children = spark.createDataFrame([("a", "x"), ("c", "a"), (None, "b"), ("c", None)], "one string, two string")
    tags = k.tagged(parents, [k.Tag("d", F.col("id"), keep=F.col("id").isNotNull())]).union(
        k.tagged(children, [k.Tag("d", F.col("one"), 1), k.Tag("d", F.col("two"), 2)]))
    counts = k.side_counts(tags, 3)
    assert sorted(tuple(r) for r in k.orphan_totals(counts, 3).collect()) == [("d", 1, 3, 2, 1), ("d", 2, 2, 2, 1)]
    assert counts.agg(k.shared_keys(counts)).first()[0] == 1


def test_findings_scan_every_extract_once(spark):
    plan = job.findings(RawExtracts(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 15


def test_only_what_looks_like_a_date_is_parsed_as_one(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-5", "+12345-01-01", "-0044-03-15", "0044-03-15", " 2024-01-01", "2024-01-01 ", "2024-01-01\n",
             "5/3/2024", "0005/03/2024", "-5/3/2024", "31/2/2024", "5/3/24", "5/3/+12024", "5/3/-2024", "a/b/2024", "2024-01-xx", "", "text"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = [F.try_to_date("t", f).isNotNull() for f in (ISO_DATE, DAY_FIRST_DATE)]
    found = rows.select((plain[0] | plain[1]).alias("plain"), (value_type("t") == DATE).alias("typed"), "t").collect()
    assert [r.t for r in found if r.plain != r.typed] == []
    assert sum(r.typed for r in found) >= 4
    plan = rows.select(value_type("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert ISO_SHAPE in plan and DAY_FIRST_SHAPE in plan


def test_rows_that_do_not_repeat_are_not_compared(spark):
    once, twice = spark.range(50).selectExpr("id % 7 AS a", "id AS b"), spark.range(50).selectExpr("id % 7 AS a", "id % 3 AS b")
    found = repeated_rows(once)
    assert "Join LeftSemi" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(50, 0)]
    assert [tuple(r) for r in repeated_rows(twice).collect()] == [(50, 29)]
    assert [tuple(r) for r in repeated_rows(once.limit(0)).collect()] == [(None, 0)]
