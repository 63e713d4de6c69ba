"""Payment rules whose outcome depends on the order of arrival.

Exact duplicates: only the first row of a business key stays.
Cap: going through a group in order, a row is accepted when the sum accepted so far plus
its amount stays within the group's cap; a rejected row uses up nothing, so a smaller row
after it may still pass. A running total cannot express that, because it would count the
rejected rows too.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.operators.joins import HOT_ROWS, lookup, survey
from ledgerloom.session import cut, fresh_path

# One digit less than Spark has, so that the sum of two amounts is exact.
AMOUNT = "decimal(37,12)"
MONEY = "decimal(38,12)"
# Longest group that is folded as one array.
FOLD_ROWS = 4096
# Rows of a long group that one task goes through.
CHUNK_ROWS = 1_000_000


def mark_first(rows: DataFrame, keys: list[str], order: str, flag: str, small: bool | None = None,
               hot_rows: int = HOT_ROWS, surveyed: DataFrame | None = None) -> DataFrame:
    """Flag the first row of every key; keys are not NULL and ``order`` is unique.

    The rows are dealt out by key once, and not at all if they lie by a part of the key
    already. The rows of hot keys stay where they are: one aggregate, combined map-side,
    finds their first rows, which meet them by ``lookup`` (``small`` is told to that).
    ``surveyed`` is a frame with the same keys that is read with less work than ``rows``.
    """
    same = Window.partitionBy(*keys)
    earliest = F.when(F.count("*").over(same) > 1, F.min(order).over(same))
    is_first = F.col("_earliest").isNull() | (F.col("_earliest") == F.col(order))
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    known = rows
    hot, unknown_keys = survey(rows if surveyed is None else surveyed, keys, hot_rows)
    if unknown_keys:
        known = rows.where(~unknown)
    found = []
    if hot:
        schema = T.StructType([T.StructField(f"_hot_{k}", rows.schema[k].dataType) for k in keys])
        listed = F.broadcast(rows.sparkSession.createDataFrame([key[:-1] for key in hot], schema))
        on = [F.col(k) == F.col(f"_hot_{k}") for k in keys]
        crowded, known = known.join(listed, on, "left_semi"), known.join(listed, on, "left_anti")
        firsts = crowded.groupBy(*keys).agg(F.min(order).alias("_earliest"))
        found.append(lookup(crowded, cut(firsts), {k: k for k in keys}, {"_earliest": "_earliest"}, small, hot_rows, [order]))
    found.append(known.withColumn("_earliest", earliest))
    marked = reduce(DataFrame.unionByName, found).withColumn(flag, is_first).drop("_earliest")
    if unknown_keys:
        marked = marked.unionByName(rows.where(unknown).withColumn(flag, F.lit(True)))
    return marked


def accept_within_cap(rows: DataFrame, keys: list[str], order: str, amount: str, cap: str, flag: str,
                      fold_rows: int = FOLD_ROWS, chunk_rows: int = CHUNK_ROWS,
                      small: bool | None = None) -> DataFrame:
    """Flag the rows accepted by the capped accumulation.

    ``cap`` is the same for all rows of a key, ``order`` is unique, none of them is NULL.

    * Groups whose positive amounts add up to no more than the cap pass whole.
    * Other groups of up to ``fold_rows`` rows are folded as an ordered array.
    * Longer groups are cut into ordered chunks, see below.
    """
    positive = F.greatest(F.col(amount), F.lit(0)).cast(MONEY)
    tight = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_group_rows"), F.max(F.col(cap).cast(MONEY)).alias("_limit"), F.sum(positive).alias("_gross"))
        .filter(F.col("_gross") > F.col("_limit"))
        .select(*keys, "_group_rows", "_limit")
    )
    tight = cut(tight)
    long_rows = tight.filter(F.col("_group_rows") > fold_rows).agg(F.sum("_group_rows")).first()[0]
    sized = lookup(rows, tight, {k: k for k in keys}, {"_group_rows": "_group_rows", "_limit": "_limit"}, small, deal=[order])

    whole = sized.filter(F.col("_group_rows").isNull()).drop("_group_rows", "_limit").withColumn(flag, F.lit(True))
    short = _accept_short(sized.filter(F.col("_group_rows") <= fold_rows), keys, order, amount, flag)
    result = whole.unionByName(short)
    if long_rows is None:
        return result
    chunks = -(-long_rows // chunk_rows)
    return result.unionByName(
        _accept_long(sized.filter(F.col("_group_rows") > fold_rows), keys, order, amount, flag, chunks))


def _accept_short(rows: DataFrame, keys: list[str], order: str, amount: str, flag: str) -> DataFrame:
    # What the group or the entry has already is not collected with every row.
    columns = [c for c in rows.columns if c not in ("_group_rows", "_limit")]
    rest = [c for c in columns if c not in (*keys, order)]
    entry = F.struct(F.col(order).alias("o"), F.col(amount).cast(MONEY).alias("a"), F.struct(*rest).alias("r"))
    groups = rows.groupBy(*keys, "_limit").agg(F.array_sort(F.collect_list(entry)).alias("_e"))

    def step(state: Column, e: Column) -> Column:
        paid = (state["paid"].cast(AMOUNT) + e["a"].cast(AMOUNT)).cast(MONEY)
        fits = paid <= F.col("_limit")
        return F.struct(F.when(fits, paid).otherwise(state["paid"]).alias("paid"),
                        F.concat(state["flags"], F.array(fits)).alias("flags"))

    start = F.struct(F.lit(0).cast(MONEY).alias("paid"), F.array().cast("array<boolean>").alias("flags"))
    flags = F.aggregate("_e", start, step, lambda s: s["flags"])
    pairs = F.arrays_zip(F.col("_e.o").alias("o"), F.col("_e.r").alias("r"), flags.alias("ok"))
    rows = groups.select(*keys, F.explode(pairs).alias("p"))
    return rows.select(*keys, F.col("p.o").alias(order), "p.r.*", F.col("p.ok").alias(flag)).select(*columns, flag)


# Groups too long for one task
#
# Rows are range-sorted by key and order, so a group becomes an ordered chain of chunks,
# one per partition. Let ``room`` be what is left under the cap and k its bit length, that
# is 2**(k-1) <= room < 2**k. While that holds, amounts below 2**(k-1) always pass, amounts
# from 2**k on never do, and one in between passes when it is at most ``room``. So for every
# k a chunk reports the sum of the small amounts, how far their running sum goes up and
# down, and the least room that lets an amount in between pass. Those numbers tell, without
# looking at rows, whether the room keeps its bit length through the chunk, and what it is
# afterwards; and then its rows pass when they are below 2**(k-1), which needs no Python.
# Only a chunk where the bit length changes needs its rows. Without negative amounts it
# changes no more often than the cap has bits, so nearly all chunks are settled by their
# summaries, however long the group is, and the few others are walked.
#
# With many refunds every chunk may have to be looked into. A chunk is a function of the
# room it is entered with, and that function is made of stretches on which it only adds a
# constant. So after two rounds of walking, one chunk and then two, all further chunks are
# turned into tables at the same time, each for the rooms that are possible there: a first
# pass takes the range of rooms through each chunk and so gets the range of the next.
# Afterwards one lookup a chunk tells the room before the next one. Only a chunk whose table
# has too many stretches is walked, and then a round walks twice as many chunks on from an
# open one as the round before it.

# Stretches of a chunk's table of rooms; a table of more is not kept.
STRETCHES = 4096


def accept_in_order(amounts: list[int], room: int) -> tuple[list[bool], int]:
    flags = []
    for a in amounts:
        fits = a <= room
        if fits:
            room -= a
        flags.append(fits)
    return flags, room


def bit_length(value: int) -> int:
    return value.bit_length() if value > 0 else 0


def summarise_chunk(amounts: list[int]) -> list[tuple[int, int, int, int, int | None]]:
    """(k, sum of small, highest and lowest running sum of small, least room for an amount
    in between) for k up to one above the largest amount's; k = -1 is for a negative room
    and carries the least amount."""
    exact_in_64 = sum(abs(a) for a in amounts) < 1 << 62
    values = np.array(amounts, dtype=np.int64 if exact_in_64 else object)
    bits = np.array([bit_length(a) for a in amounts])
    found: list[tuple[int, int, int, int, int | None]] = [(-1, 0, 0, 0, int(min(amounts)))]
    for k in range(int(bits.max()) + 2):
        # At k = 0 there is no room: negative amounts pass and zeros change nothing.
        running = np.cumsum(np.where(bits < k if k else values < 0, values, 0))
        between = (bits == k) & (k > 0)
        before = np.concatenate(([0], running[:-1]))
        least = int((values + before)[between].min()) if between.any() else None
        found.append((k, int(running[-1]), max(int(running.max()), 0), min(int(running.min()), 0), least))
    return found


def walk_chunks(chunks: list[tuple[int, dict]], room: int) -> tuple[list[tuple[int, int, int | None]], int | None]:
    """Room before each chunk as far as the summaries tell, with the largest amount that
    passes in it, and the chunk that needs its rows."""
    entered = []
    for chunk, summary in chunks:
        entered.append((chunk, room, None))
        if room < 0:
            if summary[-1][3] <= room:
                return entered, chunk
            entered[-1] = (chunk, room, room)
            continue
        k = bit_length(room)
        top = max(summary)
        total, high, low, least = summary[k] if k <= top else (*summary[top][:3], None)
        floor, ceiling = (1 << (k - 1), 1 << k) if k else (0, 1)
        if room - high < floor or room - low >= ceiling or (least is not None and least <= room):
            return entered, chunk
        entered[-1] = (chunk, room, floor - 1 if k else 0)
        room -= total
    return entered, None


def reach(amounts: Iterable[int], low: int, high: int) -> tuple[int, int]:
    """A range that holds the room after the amounts whenever the room before is in ``low..high``."""
    for a in amounts:
        if a <= low:
            low, high = low - a, high - a
        elif a <= high:
            # Smaller rooms stay as they are, the others go on from nothing.
            low, high = min(low, 0), max(a - 1, high - a)
    return low, high


def room_table(amounts: Iterable[int], low: int, high: int, most: int = STRETCHES) -> tuple[list[int], list[int]] | None:
    """The room after the amounts for every room from ``low`` to ``high`` before them: from
    each start on, up to the next one, it is the room before plus the shift. None if that
    takes more than ``most`` stretches."""
    # Amounts beyond ``high`` plus all refunds never pass; the bound keeps sums inside 64 bits.
    amounts = list(amounts)
    ceiling = max(abs(low), abs(high)) + sum(-a for a in amounts if a < 0)
    kind = np.int64 if ceiling < 1 << 61 else object
    starts, shifts = np.array([low], dtype=kind), np.array([0], dtype=kind)
    common, least, largest = 0, low, high  # added to every shift; the range of rooms now
    for a in amounts:
        if a <= least:
            common, least, largest = common - a, least - a, largest - a
            continue
        if a > largest:
            continue
        ends = np.append(starts[1:] - 1, np.array([high], dtype=kind))
        inside = (starts + shifts < a - common) & (ends + shifts >= a - common)
        if inside.any():
            starts = np.concatenate((starts, a - common - shifts[inside]))
            shifts = np.concatenate((shifts, shifts[inside]))
            order = np.argsort(starts, kind="stable")
            starts, shifts = starts[order], shifts[order]
        shifts = np.where(starts + shifts >= a - common, shifts - a, shifts)
        changes = np.append(True, shifts[1:] != shifts[:-1])
        starts, shifts = starts[changes], shifts[changes]
        if len(starts) > most:
            return None
        ends = np.append(starts[1:] - 1, np.array([high], dtype=kind))
        least, largest = int((starts + shifts).min()) + common, int((ends + shifts).max()) + common
    return [int(v) for v in starts], [int(v) + common for v in shifts]


def _whole_units(money: Column) -> Column:
    """Exact integer units of the staging scale, as text for Python's integers: the digits
    of the plain number (ANSI casts write no exponents) without the point."""
    return F.replace(money.cast(AMOUNT).cast("string"), F.lit("."), F.lit(""))


SUMMARY_TYPE = "_key string, _chunk int, _limit string, k int, total string, high string, low string, least string"
PASSED_TYPE = "_key string, _after int, _room string"
RANGE_TYPE = "_key string, _chunk int, _low string, _high string"
# What is known of a chunk: the room after it, or its table.
KNOWN_TYPE = "_key string, _after int, _room string, _starts string, _shifts string"
ENTERED_TYPE = "_key string, _chunk int, _room string, _most string, _open boolean"


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Summaries of the chunks of one partition; its rows come sorted by key."""

    def report(head: tuple, amounts: list[int]) -> pd.DataFrame:
        rows = [(*head, k, *map(str, sums), None if least is None else str(least))
                for k, *sums, least in summarise_chunk(amounts)]
        return pd.DataFrame(rows, columns=["_key", "_chunk", "_limit", "k", "total", "high", "low", "least"])

    head, held = None, []
    for batch in batches:
        for group, part in batch.groupby(["_key", "_chunk", "_limit"], sort=False):
            if head is not None and head != group:
                yield report(head, held)
                held = []
            head = group
            held.extend(map(int, part["_units"]))
    if head is not None:
        yield report(head, held)


def _chain(key: tuple, summaries: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Chain the chunk summaries of one key; there is at most one chunk per partition."""
    table: dict[int, dict] = {}
    for row in summaries.itertuples(index=False, name=None):
        _, chunk, _, k, total, high, low, least = row
        table.setdefault(int(chunk), {})[int(k)] = (
            int(total), int(high), int(low), None if pd.isna(least) else int(least))
    after = {int(c): int(r) for c, r in zip(known["_after"], known["_room"]) if not pd.isna(r)}
    tables = {int(c): (s, d) for c, s, d in zip(known["_after"], known["_starts"], known["_shifts"]) if not pd.isna(s)}
    todo, room = sorted(table.items()), int(summaries["_limit"].iloc[0])
    at, entered = 0, []
    while True:
        found, stop = walk_chunks(todo[at:], room)
        entered.extend(found)
        at += len(found)
        if stop in after:
            room = after[stop]
        elif stop in tables:
            starts, shifts = ([int(v) for v in part.split(",")] for part in tables[stop])
            room = found[-1][1]
            room += shifts[bisect_right(starts, room) - 1]
        else:
            break
    return pd.DataFrame([(key[0], c, str(r), None if m is None else str(m), c == stop) for c, r, m in entered],
                        columns=["_key", "_chunk", "_room", "_most", "_open"])


def _chunks_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Iterator[int]]]:
    """The chunks of a partition that is sorted by key and chunk: key, chunk and range of rooms, and the amounts."""
    rows = (r for b in batches for r in zip(b["_key"], b["_chunk"], b["_low"], b["_high"], b["_units"]))
    for head, part in groupby(rows, key=lambda r: r[:4]):
        yield (head[0], head[1], int(head[2]), int(head[3])), (int(r[4]) for r in part)


def _reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The range of rooms after each chunk."""
    for (key, chunk, low, high), amounts in _chunks_of(batches):
        yield pd.DataFrame([(key, chunk, *map(str, reach(amounts, low, high)))], columns=["_key", "_chunk", "_low", "_high"])


def _tabulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tables of the chunks that have one."""
    for (key, chunk, low, high), amounts in _chunks_of(batches):
        found = room_table(amounts, low, high)
        if found:
            texts = [",".join(map(str, part)) for part in found]
            yield pd.DataFrame([(key, chunk, None, *texts)], columns=["_key", "_after", "_room", "_starts", "_shifts"])


def _room_tables(ordered: DataFrame, summaries: DataFrame, opened: DataFrame) -> DataFrame:
    """Tables of the open chunks and of all that come after them in their groups, a task for each chunk."""
    # The room is never above the cap and all refunds so far, and below nothing only if the cap is.
    refunds = -F.col("total").cast("decimal(38,0)")
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for each chunk
    limit = F.col("_limit").cast("decimal(38,0)")
    widest = summaries.where("k = 0").withColumn("_refunded", F.coalesce(F.sum(refunds).over(before), F.lit(0)))
    widest = widest.join(opened.select("_key", "_from"), "_key").where(F.col("_chunk") >= F.col("_from")).select(
        "_key", "_chunk", F.least(limit, F.lit(0)).cast("string").alias("_low"),
        (limit + F.col("_refunded")).cast("string").alias("_high"))
    rows = ordered.select("_key", "_chunk", "_place", "_units")

    def chunkwise(ranges: DataFrame) -> DataFrame:
        held = rows.join(ranges, ["_key", "_chunk"]).repartition("_key", "_chunk")
        return held.sortWithinPartitions("_key", "_chunk", "_place").drop("_place")

    after = cut(chunkwise(widest).mapInPandas(_reach, RANGE_TYPE))
    # A chunk is entered with a room that the chunk before it leaves; the open one may be entered with any.
    previous = Window.partitionBy("_key").orderBy("_chunk")
    entered = widest.join(after.withColumnsRenamed({"_low": "_least", "_high": "_largest"}), ["_key", "_chunk"]).select(
        "_key", "_chunk", F.coalesce(F.lag("_least").over(previous), "_low").alias("_low"),
        F.coalesce(F.lag("_largest").over(previous), "_high").alias("_high"))
    return cut(chunkwise(cut(entered)).mapInPandas(_tabulate, KNOWN_TYPE))


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Goes through open chunks row by row; rows come sorted by key, chunk and place. ``_room``
    is what the first of a key's chunks is entered with."""
    here, room = None, 0
    for batch in batches:
        done = []
        for key, chunk, start, units in zip(batch["_key"], batch["_chunk"], batch["_room"], batch["_units"]):
            if here is not None and here != (key, chunk):
                done.append((*here, str(room)))
            if here is None or here[0] != key:
                room = int(start)
            here = (key, chunk)
            if int(units) <= room:
                room -= int(units)
        yield pd.DataFrame(done, columns=["_key", "_after", "_room"])
    if here is not None:
        yield pd.DataFrame([(*here, str(room))], columns=["_key", "_after", "_room"])


def _accept_long(rows: DataFrame, keys: list[str], order: str, amount: str, flag: str, chunks: int) -> DataFrame:
    columns = [c for c in rows.columns if c not in ("_group_rows", "_limit")]
    ordered = (
        rows.select(*columns, F.to_json(F.struct(*keys)).alias("_key"), _whole_units(F.col("_limit")).alias("_limit"),
                    _whole_units(F.col(amount)).alias("_units"))
        .repartitionByRange(chunks, "_key", order).sortWithinPartitions("_key", order)
        .select("*", F.spark_partition_id().alias("_chunk"), F.monotonically_increasing_id().alias("_place"))
    )
    # Every pass below sees the same rows in a chunk, and reads the chunks it needs only.
    path = fresh_path(rows.sparkSession)
    ordered.write.partitionBy("_chunk").parquet(path)
    ordered = rows.sparkSession.read.schema(ordered.schema).parquet(path)
    summaries = ordered.select("_key", "_chunk", "_limit", "_units", "_place")
    summaries = summaries.repartition("_chunk").sortWithinPartitions("_chunk", "_place").drop("_place")
    summaries = cut(summaries.mapInPandas(_summaries, SUMMARY_TYPE))
    known = rows.sparkSession.createDataFrame([], KNOWN_TYPE)
    stride, tabled = 1, False
    while True:
        entered = cut(summaries.groupBy("_key").cogroup(known.groupBy("_key")).applyInPandas(_chain, ENTERED_TYPE))
        opened = entered.filter("_open").select("_key", "_room", F.col("_chunk").alias("_from"))
        starts = [r[0] for r in opened.select("_from").distinct().collect()]  # at most one per chunk
        if not starts:
            break
        if stride > 2 and not tabled:
            known = cut(known.unionByName(_room_tables(ordered, summaries, opened)))
            stride, tabled = 1, True
            continue
        wanted = sorted({c + i for c in starts for i in range(stride) if c + i < chunks})
        here = ordered.where(F.col("_chunk").isin(wanted)).select("_key", "_chunk", "_place", "_units").join(opened, "_key")
        here = here.where((F.col("_chunk") >= F.col("_from")) & (F.col("_chunk") < F.col("_from") + stride))
        here = here.repartition("_key").sortWithinPartitions("_key", "_chunk", "_place")
        walked = here.select("_key", "_chunk", "_room", "_units").mapInPandas(_walk, PASSED_TYPE)
        known = cut(known.unionByName(walked, allowMissingColumns=True))
        stride *= 2

    at_chunk = ordered.join(entered.select("_key", "_chunk", "_room", "_most"), ["_key", "_chunk"])
    whole = "decimal(38,0)"
    settled = at_chunk.where(F.col("_most").isNotNull()).select(
        *columns, (F.col("_units").cast(whole) <= F.col("_most").cast(whole)).alias(flag))
    walked = at_chunk.where(F.col("_most").isNull())
    walked = walked.repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", "_place")
    schema = T.StructType([*[ordered.schema[c] for c in columns], T.StructField(flag, T.BooleanType())])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, room = None, 0
        for batch in batches:
            flags = []
            for k, chunk, start, units in zip(*(batch[c].to_pylist() for c in ("_key", "_chunk", "_room", "_units"))):
                if (k, chunk) != here:
                    here, room = (k, chunk), int(start)
                fits = int(units) <= room
                room -= int(units) if fits else 0
                flags.append(fits)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(flags, pa.bool_())],
                                             names=[*columns, flag])

    return settled.unionByName(walked.mapInArrow(decide, schema))


# The functions above travel with the tasks, so workers need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
