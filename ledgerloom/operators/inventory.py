"""Stock changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup
from ledgerloom.sources.manifest import StoredTable, hashed_part


def apply_deltas(stock: DataFrame, deltas: DataFrame, keys: list[str], quantity: str, delta: str) -> DataFrame:
    """The stock after all signed deltas. Deltas of a key are added up first, so their order
    does not matter; every stock row with that key changes by the sum, and none is repeated."""
    sums = deltas.groupBy(*keys).agg(F.sum(delta).alias("_delta"))
    changed = lookup(stock, sums, {k: k for k in keys}, {"_delta": "_delta"})
    new = (F.col(quantity) + F.coalesce(F.col("_delta"), F.lit(0))).cast(stock.schema[quantity].dataType)
    return changed.withColumn(quantity, new).drop("_delta")


def change_stored(table: StoredTable, deltas: DataFrame, keys: list[str], quantity: str, delta: str, parts: int, change_id: str) -> list[str]:
    """Apply deltas to a stored table that is parted by a hash of its keys, once for each change id: the parts written anew.
    Parts without a delta, or whose deltas add up to nothing for every key, are not opened."""
    part = hashed_part(keys, parts)
    sums = deltas.groupBy(*keys).agg(F.sum(delta).alias(delta)).where(F.col(delta) != 0)
    touched = [r.part for r in sums.select(part.alias("part")).distinct().collect()]  # at most one row for each part
    return table.rewrite(touched, lambda stock: apply_deltas(stock, sums, keys, quantity, delta), part, change_id)
