"""Relations between sets of keys, answered together.

Every table emits its keys once, tagged with the domain they belong to and the side they are on. One aggregate by domain and key
then tells which sides have a key and how often; orphans, overlaps and repeats are sums over that, for all domains at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARENT = 0


@dataclass(frozen=True)
class Tag:
    """A key that a row emits: ``side`` 0 is the set that others refer to. ``keep`` says which rows do, ``more`` adds values."""

    domain: str
    key: Column
    side: int = PARENT
    keep: Column | None = None
    more: dict[str, Column] = field(default_factory=dict)


def tagged(df: DataFrame, tags: list[Tag], more: dict[str, str] | None = None) -> DataFrame:
    """``domain, key, side`` and the values of ``more`` (name to type, null where a tag has none) for all tags, in one scan."""
    entries = []
    nothing = {name: F.lit(None).cast(kind).alias(name) for name, kind in (more or {}).items()}
    for tag in tags:
        values = [tag.more[name].cast(more[name]).alias(name) if name in tag.more else none for name, none in nothing.items()]
        entry = F.struct(F.lit(tag.domain).alias("domain"), tag.key.cast("string").alias("key"), F.lit(tag.side).alias("side"), *values)
        entries.append(entry if tag.keep is None else F.when(tag.keep, entry))
    return df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")


def side_counts(tags: DataFrame, sides: int) -> DataFrame:
    """``domain, key, n0, n1, ...``: how many rows of each side have a key. Tasks add up their own keys first."""
    return tags.groupBy("domain", "key").agg(*[F.count_if(F.col("side") == k).alias(f"n{k}") for k in range(sides)])


def orphan_totals(counts: DataFrame, sides: int) -> DataFrame:
    """``domain, side, orphans, keys, repeats``: rows of each side beyond the first whose key the first one lacks (a null key is
    nobody's), keys of the first side, and rows of it that repeat a key."""
    lost = F.col("key").isNull() | (F.col(f"n{PARENT}") == 0)
    orphans = F.array(*[F.struct(F.lit(k).alias("side"), F.coalesce(F.sum(F.when(lost, F.col(f"n{k}"))), F.lit(0)).alias("orphans"))
                        for k in range(1, sides)])
    had = F.col(f"n{PARENT}")
    totals = counts.groupBy("domain").agg(orphans.alias("o"), F.count_if(had > 0).alias("keys"), F.sum(F.greatest(had - 1, F.lit(0))).alias("repeats"))
    return totals.select("domain", F.explode("o").alias("o"), "keys", "repeats").select("domain", "o.*", "keys", "repeats")


def shared_keys(counts: DataFrame) -> Column:
    """How many keys the first two sides share; an aggregate."""
    return F.count_if(F.col("key").isNotNull() & (F.col("n0") > 0) & (F.col("n1") > 0))


DECIMAL = T.DecimalType(37, 12).simpleString()
