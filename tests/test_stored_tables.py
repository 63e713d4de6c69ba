"""Tables under a manifest: partial changes, moves to an archive, and runs that stop in between."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.inventory import change_stored
from ledgerloom.plans import layout, publish
from ledgerloom.sources import schemas
from ledgerloom.sources.manifest import StoredTable, hashed_part

PARTS = 8


def files(root):
    return {str(p) for p in Path(root).rglob("*.parquet")}


@pytest.fixture
def stock(spark, tmp_path):
    rows = spark.range(200).select("id", (F.col("id") % 3).cast("int").alias("place"), F.lit(100).alias("on_hand"))
    table = StoredTable(spark, str(tmp_path / "stock"), rows.schema)
    table.create(rows, hashed_part(["id", "place"], PARTS))
    return table


def deltas(spark, rows):
    return spark.createDataFrame(rows, "id long, place int, delta long")


def change(table, rows, change_id="one"):
    return change_stored(table, deltas(table.spark, rows), ["id", "place"], "on_hand", "delta", PARTS, change_id)


def values(table):
    return {r.id: r.on_hand for r in table.read().collect()}


def test_only_touched_parts_are_written_anew(spark, stock):
    before, folders = files(stock.root), stock.manifest().parts
    touched = change(stock, [(5, 2, -7), (5, 2, 2), (6, 0, 4), (6, 0, -4), (7, 0, 9), (999, 0, 1)])
    # 6 adds up to nothing, 7 stands at another place, 999 is not there: only what could change is opened.
    assert 1 <= len(touched) <= 3
    assert values(stock) == {i: 95 if i == 5 else 100 for i in range(200)}
    after = stock.manifest().parts
    assert {n for n in folders if folders[n] != after[n]} == set(touched)
    stock.remove_unlisted()
    kept = {f for f in before if not any(f"/_part={n}/" in f for n in touched)}
    assert kept <= files(stock.root) and not (before - kept) & files(stock.root)


def test_a_change_counts_once(spark, stock):
    change(stock, [(1, 1, -10)], "monday")
    assert change(stock, [(1, 1, -10)], "monday") == []
    change(stock, [(1, 1, -10)], "tuesday")
    assert values(stock)[1] == 80 and sum(values(stock).values()) == 200 * 100 - 20
    assert change(stock, [], "nothing") == []


def test_a_stop_before_the_switch_changes_nothing(spark, stock, monkeypatch):
    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(StoredTable, "switch", stop)
        with pytest.raises(RuntimeError):
            change(stock, [(1, 1, -10)])
    assert values(stock) == dict.fromkeys(range(200), 100)
    assert len(stock.remove_unlisted()) == 1
    assert change(stock, [(1, 1, -10)]) and values(stock)[1] == 90


def test_rows_may_not_leave_their_parts(spark, stock):
    with pytest.raises(ValueError, match="moved"):
        stock.rewrite(["0"], lambda rows: rows.withColumn("id", F.col("id") + 1), hashed_part(["id", "place"], PARTS), "x")


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType())])


@pytest.fixture
def history(spark, tmp_path):
    moment = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id AS int))")
    table = StoredTable(spark, str(tmp_path / "active"), SCHEMA)
    table.create(spark.range(150).select("id", moment.alias("at")), layout.month_part("at"))
    return table


@pytest.mark.parametrize("stop_at", [None, "write", "switch", "remove_unlisted"])
def test_archive_reads_whole_whenever_a_run_stops(spark, tmp_path, history, monkeypatch, stop_at):
    archive = str(tmp_path / "archive")
    real = {name: getattr(StoredTable, name) for name in ("write", "switch", "remove_unlisted")}

    def broken(name):
        def run(*args):
            if name != "remove_unlisted":
                real[name](*args) if name == "write" else None
            raise RuntimeError("lost")

        return run

    if stop_at:
        with monkeypatch.context() as patched:
            patched.setattr(StoredTable, stop_at, broken(stop_at))
            with pytest.raises(RuntimeError):
                layout.archive_listed(history, "at", archive, date(2024, 3, 1))
        assert sorted(r.id for r in history.read().collect()) == list(range(150))
    moved = layout.archive_listed(history, "at", archive, date(2024, 3, 1))
    assert moved == ([] if stop_at == "remove_unlisted" else ["2024-01", "2024-02"])
    tiers = {t: sorted(r.id for r in history.read(tier=t).collect()) for t in ("archive", "active")}
    assert tiers == {"archive": list(range(60)), "active": list(range(60, 150))}
    listed = {folder for folder, _ in history.manifest().parts.values()}
    assert {str(Path(f).parent) for f in files(tmp_path)} == listed
    assert all(f.startswith(archive) == (n < "2024-03") for n, (f, _) in history.manifest().parts.items())


def test_empty_tables(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path), SCHEMA)
    assert table.read().collect() == [] and table.manifest().parts == {}
    table.create(spark.createDataFrame([], SCHEMA), layout.month_part("at"))
    assert table.read().collect() == [] and layout.archive_listed(table, "at", str(tmp_path / "a"), date(2030, 1, 1)) == []


def test_counts_are_observed_while_writing(spark, tmp_path):
    seen = publish.counted("t", spark.range(1234).repartition(7), lambda rows: rows.write.parquet(str(tmp_path / "t")))
    assert seen == 1234 == spark.read.parquet(str(tmp_path / "t")).count()
    assert schemas.star_schema("Customers").names[0] == "customer_id"
