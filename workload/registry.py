"""Where query modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        @wraps(run)
        def configured(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        SPARK[name] = configured
        if sql is not None:
            ORACLE[name] = sql
        return configured

    return add
