"""Key lookups and integrity checks that stay balanced when one key holds most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import estimated_bytes

# At most this many keys are salted, so only a list of that length is ever broadcast. A key
# beyond them has less than a thousandth of the rows and is left to adaptive skew splitting.
MAX_HOT_KEYS = 1000
# A key with fewer rows than this is no burden for a single task; one with more gets a slot
# for every so many.
HOT_ROWS = 100_000


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast the frame."""
    spark = df.sparkSession
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))
    return estimated_bytes(df) <= limit


def hot_keys(facts: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> list[tuple]:
    """The keys that hold the most rows, ``MAX_HOT_KEYS`` at most, and how many each."""
    return survey(facts, keys, hot_rows)[0]


def survey(facts: DataFrame, keys: list[str], hot_rows: int) -> tuple[list[tuple], bool]:
    """The hot keys, and whether any row has a NULL among its keys.

    One pass over the key columns feeds a frequent-items sketch of the keys' hashes, and only
    sketches are shuffled. If a hash is hot, a second pass tells its keys. A key the sketch
    misses takes the ordinary path of the caller, so results never depend on it.
    """
    known = facts.select(*keys).dropna()
    hashed = F.xxhash64(*keys)
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    sketch = f"approx_top_k(_hash, {MAX_HOT_KEYS}, {MAX_HOT_KEYS * 16}) FILTER (WHERE _whole)"
    top, unknown = facts.select(hashed.alias("_hash"), whole.alias("_whole")).agg(
        F.expr(sketch), F.count_if(~F.col("_whole"))).first()
    hot = [t["item"] for t in top or [] if t["count"] >= hot_rows]
    if not hot:
        return [], unknown > 0
    found = known.where(hashed.isin(hot)).groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= hot_rows)
    return [tuple(row) for row in found.orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS).collect()], unknown > 0


def lookup(facts: DataFrame, parents: DataFrame, on: dict[str, str], values: dict[str, str],
           small: bool | None = None, hot_rows: int | None = HOT_ROWS, deal: list[str] | None = None) -> DataFrame:
    """Left join ``facts`` to ``parents``, which has one row per key.

    ``on`` maps fact columns to parent columns, ``values`` new fact columns to parent
    columns. Parents that Spark can broadcast need nothing else; ``small`` says so where
    the caller has counted them. Beyond that size the hot keys are salted: their fact rows
    are spread over a slot for every ``hot_rows`` of them and their single parent row is
    copied to each. Rows with a NULL key match nothing and do not take part in the join.

    The slot follows from the row's values, so a task that is run again deals alike. ``deal``
    names the columns it follows from, which tell most rows of a key apart: without it, all
    columns have to be worked out, also those that nobody asks for later. Without ``hot_rows``
    none is looked for: the caller knows that keys are unique and not NULL.
    """
    keys = list(on)
    side = parents.select(
        *[F.col(p).alias(f"_on_{f}") for f, p in on.items()],
        *[F.col(p).alias(v) for v, p in values.items()],
    )
    side_keys = [f"_on_{k}" for k in keys]
    same_key = [F.col(k) == F.col(f"_on_{k}") for k in keys]
    if small is None:
        small = fits_broadcast(side)
    if small:
        return facts.join(side, same_key, "left").drop(*side_keys)

    hot_ones, unknown_keys = survey(facts, keys, hot_rows) if hot_rows else ([], False)
    rows = [(*key, -(-n // hot_rows)) for *key, n in hot_ones]
    if not rows and not unknown_keys:
        return facts.join(side, same_key, "left").drop(*side_keys)
    schema = T.StructType([*[T.StructField(f"_hot_{k}", facts.schema[k].dataType) for k in keys],
                           T.StructField("_slots", T.LongType())])
    hot = F.broadcast(facts.sparkSession.createDataFrame(rows, schema))
    spare = ["_slots", *[f"_hot_{k}" for k in keys]]

    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    plain = deal or [c for c, t in facts.dtypes if "map<" not in t]
    place = 1 + F.pmod(F.xxhash64(*plain), F.col("_slots"))
    left = facts.where(~unknown).join(hot, [F.col(k) == F.col(f"_hot_{k}") for k in keys], "left")
    left = left.withColumn("_slot", F.coalesce(place, F.lit(0)).cast("bigint")).drop(*spare)

    copies = F.sequence(F.lit(1).cast("bigint"), F.col("_slots"))
    slots = F.coalesce(copies, F.array(F.lit(0).cast("bigint")))
    right = side.join(hot, [F.col(f"_on_{k}") == F.col(f"_hot_{k}") for k in keys], "left")
    right = right.withColumn("_on_slot", F.explode(slots)).drop(*spare)
    found = left.join(right, [*same_key, F.col("_slot") == F.col("_on_slot")], "left").drop(
        "_slot", "_on_slot", *side_keys)
    nothing = {v: F.lit(None).cast(side.schema[v].dataType) for v in values}
    return found.unionByName(facts.where(unknown).withColumns(nothing).select(*found.columns))


def flag_known(facts: DataFrame, parents: DataFrame, on: dict[str, str], flag: str,
               small: bool | None = None, hot_rows: int = HOT_ROWS, deal: list[str] | None = None) -> DataFrame:
    """Mark each fact with whether its key exists among the parents; a NULL key does not."""
    known = parents.select(*on.values()).distinct().withColumn("_known", F.lit(True))
    found = lookup(facts, known, on, {flag: "_known"}, small, hot_rows, deal)
    return found.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(facts: DataFrame, parents: DataFrame, on: dict[str, str]) -> DataFrame:
    """Facts without a parent, rows with a NULL key among them; those are never shuffled."""
    unknown = F.lit(False)
    for f in on:
        unknown = unknown | F.col(f).isNull()
    matches = [facts[f] == parents[p] for f, p in on.items()]
    lost = facts.where(~unknown).join(parents.select(*on.values()), matches, "left_anti")
    return lost.union(facts.where(unknown))


def latest_by_key(rows: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """One row per key, the last in order; combined map-side, so repeats never gather."""
    return rows.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])
