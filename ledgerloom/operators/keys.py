"""Dense surrogate keys in insertion order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.session import cut, fresh_path, release, remove_path

# ``monotonically_increasing_id`` keeps the partition above and the row below this bit.
ROW_BITS = 33


def assign_keys(rows: DataFrame, key: str, order: list[str], first: int = 1) -> DataFrame:
    """Number the rows ``first, first + 1, ...`` by ``order``, which is unique.

    The rows are range-sorted once and written with their place, so only the row counts of
    the partitions are added up, and no window runs over the data.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return numbered.select((F.col("_offset") + row + first).alias(key), *rows.columns)


# Numbers that share all bits above these make one bitmap, the size of Spark's own.
MAP_BITS = 15
MAP_BYTES = 1 << MAP_BITS - 3
# A row is looked up in a stretch of its bitmap: so many bytes, eight numbers each.
STRETCH_BYTES = 64
STRETCH_BITS = 9
# Bitmaps that hold less than a row for this many numbers are no shorter than the rows.
SPARSE = 512
# Stretches of up to this many bytes go to every executor.
BROADCAST_BYTES = 16 << 20


def _rank(bits: Column, number: Column) -> Column:
    """How many numbers of a stretch come before this one."""
    place = number.bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)).cast("int")
    whole = F.bitmap_count(F.substring(bits, F.lit(1), F.shiftright(place, 3)))
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    lower = F.element_at(F.array(*[F.lit((1 << b) - 1) for b in range(8)]), place.bitwiseAND(F.lit(7)) + 1)
    return whole + F.bit_count(byte.bitwiseAND(lower))


def assign_by_position(rows: DataFrame, key: str, groups: list[str], position: str, first: int = 1) -> DataFrame:
    """What ``assign_keys`` gives for the order ``groups, position``, without sorting the rows.

    A position is a whole number, or a struct whose last field is one and whose other fields
    say which split of which file the row comes from. The numbers that occur make bitmaps,
    a bit for each, combined map-side; a row's key is the count of rows in all bitmaps before
    its own and of the bits before its own. So rows stay in their partitions as long as the
    bitmaps can be broadcast (16 MB hold some 60 million rows), and are hashed once beyond.

    Positions of another type, sparse ones, and such as repeat or are NULL are range-sorted.

    The rows are written first, so that the shuffle files behind them are gone before those of the sort.
    """
    spark, written = rows.sparkSession, fresh_path(rows.sparkSession)
    placed = cut(rows, written)
    release(spark)

    def sorted_keys() -> DataFrame:
        keyed = assign_keys(placed, key, [*groups, position], first)
        remove_path(spark, written)  # the sorted rows are written again
        return keyed

    kind = rows.schema[position].dataType
    fields = kind.fieldNames() if isinstance(kind, T.StructType) else []
    last = kind.fields[-1].dataType if fields else kind
    if not isinstance(last, T.IntegralType):
        return sorted_keys()
    within = [*[F.col(f"`{g}`") for g in groups], *[F.col(f"`{position}`")[f] for f in fields[:-1]]]
    number = (F.col(f"`{position}`")[fields[-1]] if fields else F.col(f"`{position}`")).cast("long")
    names = [f"_in{i}" for i in range(len(within))]

    numbers = placed.select(*[c.alias(n) for c, n in zip(within, names)], number.alias("_number"))
    bit = F.col("_number").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    maps = cut(numbers.groupBy(*names, F.shiftright("_number", MAP_BITS).alias("_map"))
               .agg(F.bitmap_construct_agg(bit).alias("_bits"), F.count("*").alias("_n")))
    found, counted, distinct = maps.agg(F.count("*"), F.sum("_n"), F.sum(F.bitmap_count("_bits"))).first()
    if counted != distinct or found * MAP_BYTES * 8 > SPARSE * (counted or 0):
        return sorted_keys()

    # Running counts: over the bitmaps of a split, and over the splits.
    so_far = Window.partitionBy(*names).orderBy("_map").rowsBetween(Window.unboundedPreceding, -1)
    splits = maps.groupBy(*names).agg(F.sum("_n").alias("_n"))
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(*[F.col(n).alias(f"{n}s") for n in names], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}s"))
    counts = maps.select(*names, "_map", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_inside"))
    counts = counts.join(F.broadcast(splits), same).select(*names, "_map", (F.col("_earlier") + F.col("_inside")).alias("_before"))
    same_map = F.col("_map") == F.col("_maps")
    for n in names:
        same_map = same_map & F.col(n).eqNullSafe(F.col(f"{n}s"))
    counts = counts.withColumnsRenamed({n: f"{n}s" for n in [*names, "_map"]})
    cuts = F.sequence(F.lit(0), F.lit(MAP_BYTES // STRETCH_BYTES - 1))
    stretches = maps.join(counts, same_map).select(*names, "_map", "_bits", "_before", F.explode(cuts).alias("_cut"))
    stretches = stretches.select(
        *[F.col(n).alias(f"{n}s") for n in names],
        (F.shiftleft("_map", MAP_BITS - STRETCH_BITS) + F.col("_cut")).alias("_stretch"),
        (F.col("_before") + F.bitmap_count(F.substring("_bits", F.lit(1), F.col("_cut") * STRETCH_BYTES))).alias("_before"),
        F.substring("_bits", F.col("_cut") * STRETCH_BYTES + 1, F.lit(STRETCH_BYTES)).alias("_bits"),
    ).where(F.bitmap_count("_bits") > 0)

    here = F.shiftright(number, STRETCH_BITS) == F.col("_stretch")
    for c, n in zip(within, names):
        here = here & c.eqNullSafe(F.col(f"{n}s"))
    # What a stretch takes beside its bits: count, number, and the names of file and group.
    small = found * MAP_BYTES // STRETCH_BYTES * (STRETCH_BYTES + 64) <= BROADCAST_BYTES
    numbered = placed.join(F.broadcast(stretches) if small else stretches.hint("shuffle_hash"), here)
    return numbered.select((F.col("_before") + _rank(F.col("_bits"), number) + first).alias(key), *[F.col(f"`{c}`") for c in rows.columns])
