"""Every registered query agrees with its SQL on the smallest tables."""

import os

import pytest

import workload.all_queries  # noqa: F401
from tests.oracle import differences, duck
from workload.registry import ORACLE, SPARK

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert differences(spark, con, name, FOLDER) == []


def test_every_query_has_sql():
    assert set(SPARK) == set(ORACLE)


def test_long_groups_equal_a_loop(spark):
    rows = SPARK["capped_long_groups"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/events.parquet")
    # Every fifth event is a refund.
    cents = {r.event_id: (r.event_type, (-1 if r.event_id % 5 == 0 else 1) * round(r.value * 100)) for r in table.collect()}
    paid, want = {}, {}
    for event_id, (kind, amount) in sorted(cents.items()):
        want[event_id] = paid.get(kind, 0) + amount <= 100_000
        paid[kind] = paid.get(kind, 0) + (amount if want[event_id] else 0)
    assert {r.event_id: r.accepted for r in rows} == want
