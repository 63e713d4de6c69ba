"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, and the original vectors.

A rotation is learned on a sample so that the signs of the rotated vectors are balanced bits that fit them closely. The bits
are cut into substrings, one for each table; vectors that agree in a substring meet in a bucket. The tables' number follows
from their width, so that two vectors at the threshold meet in one of them nearly always; the width grows with the
logarithm of the rows, so that buckets stay small. In a bucket the cosines of the original vectors decide.

Equal vectors are one class, and count with their number. A bucket with many classes is dealt out in blocks; every two blocks
are one task's work, and tasks give back counts and roots for each vector, never pairs. A pair that meets in several tables
counts in the first.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, kept, ship
from ledgerloom.llm.components import components
from ledgerloom.llm.whitening import matrix, usable
from ledgerloom.operators.joins import lookup
from ledgerloom.session import cut

LEAST_COSINE = 0.98
SAMPLE = 20_000  # distinct vectors that the rotations are learned on, about; a hash picks them
STEPS = 30  # of the iterative quantisation
MISSED = 0.01  # share of pairs right at the threshold that meet in no table, at most, were the bits those of random planes
LEAST_WIDTH = 8
# The mean is taken off for balance. A mean longer than this lies among the vectors of one direction that most rows share, and
# planes through it would tear near copies apart; the planes then go through the origin.
CENTRED = 0.5
BLOCK = 512  # classes of a bucket that are compared at a time
FEW = 4  # groups of so few classes are compared many at a time
SALTS = 16


def learn_rotation(x: np.ndarray, seed: int, steps: int = STEPS) -> np.ndarray:
    """The rotation of centred rows whose signs lose least: signs and rotation are fitted to each other in turn."""
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1], x.shape[1])))
    for _ in range(steps):
        signs = np.where(x @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(x.T @ signs)
        rotation = left @ right
    return rotation


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; a power of two keeps their squares in range."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(length > 0, length, 1)[:, None]


def plan_tables(rows: int, cosine: float) -> tuple[int, int]:
    """Bits of a substring, and how many tables: a bit of two vectors at the threshold agrees with probability 1 - angle / pi."""
    width = max(LEAST_WIDTH, min(48, math.ceil(math.log2(max(rows, 2)))))
    agree = (1 - math.acos(cosine) / math.pi) ** width
    return width, max(1, math.ceil(math.log(MISSED) / math.log1p(-agree))) if agree < 1 else 1


class Codes:
    """Hyperplanes whose sides are bits, in substrings of ``width`` bits, one for each table."""

    def __init__(self, mean: np.ndarray, planes: np.ndarray, width: int):
        self.mean, self.planes, self.width, self.tables = mean, planes, width, planes.shape[1] // width

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The substrings of unit rows, one number for each table."""
        bits = (x - self.mean) @ self.planes > 0
        places = 1 << np.arange(self.width, dtype=np.int64)
        return bits.reshape(len(x), self.tables, self.width).astype(np.int64) @ places


def learn_codes(sample: np.ndarray, width: int, tables: int) -> Codes:
    """Rotations learned on sample rows, with as many bits as the tables need."""
    x = unit(sample)
    mean = x.mean(axis=0)
    if np.linalg.norm(mean) > CENTRED:
        mean = np.zeros_like(mean)
    centred = x - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)  # principal axes, strongest first
    planes: list[np.ndarray] = []
    while sum(p.shape[1] for p in planes) < width * tables:
        planes.append(axes.T @ learn_rotation(centred @ axes.T, len(planes)))
    return Codes(mean, np.concatenate(planes, axis=1)[:, :width * tables], width)


def codes_of(mean: np.ndarray, planes: np.ndarray, width: int, **_) -> Codes:
    return Codes(mean, planes, width)


def roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each row's component of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None], len(label)).min(axis=1, initial=len(label))
        now = np.minimum(label, near)
        now = np.minimum(now, now[now])
        if (now == label).all():
            return label
        label = now


def compare_groups(ids: np.ndarray, times: np.ndarray, own: np.ndarray, x: np.ndarray, keys: np.ndarray, table: np.ndarray,
                   starts: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float) -> list[np.ndarray]:
    """Rows (id, links, linked id) for groups of rows that lie one after the other from ``starts`` on.

    ``own`` is a row's block; a group of one block compares all its rows, one of two blocks those of different blocks.
    """
    out: list[np.ndarray] = []
    ends = np.append(starts[1:], len(ids))
    sizes = ends - starts

    def meets(u: np.ndarray, v: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether rows agree in no table before ``t``; they agree in ``t``."""
        return (keys[u] == keys[v]).argmax(axis=1) == t

    for size in range(2, FEW + 1):
        at = starts[sizes == size]
        group = np.flatnonzero(sizes == size)
        for i in range(size):
            for j in range(i + 1, size):
                u, v, g = at + i, at + j, group
                keep = (first[g] == second[g]) | (own[u] != own[v])
                u, v, g = u[keep], v[keep], g[keep]
                keep = (np.einsum("ij,ij->i", x[u], x[v]) >= cosine) & meets(u, v, table[g])
                u, v = u[keep], v[keep]
                out += [np.stack([ids[u], times[v], ids[v]], axis=1), np.stack([ids[v], times[u], ids[u]], axis=1)]
    for g in np.flatnonzero(sizes > FEW):
        rows = slice(starts[g], ends[g])
        linked = x[rows] @ x[rows].T >= cosine
        np.fill_diagonal(linked, False)
        if first[g] != second[g]:
            linked &= own[rows, None] != own[None, rows]
        for t in range(table[g]):
            linked &= keys[rows, t, None] != keys[None, rows, t]
        has = np.flatnonzero(linked.any(axis=1))
        if len(has):
            linked = linked[np.ix_(has, has)]
            mine = ids[rows][has]
            out.append(np.stack([mine, linked.astype(np.int64) @ times[rows][has], mine[roots(linked)]], axis=1))
    return out


LINKS = "cid long, links long, other long"


def _keys(shipped) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        codes, dims = kept(shipped, codes_of), shipped.value["dims"]
        for batch in batches:
            keys = codes.keys(unit(matrix(batch.column("vector"), dims)))
            again = pa.array(np.repeat(np.arange(batch.num_rows), codes.tables))
            yield pa.RecordBatch.from_arrays([
                batch.column("cid").take(again), batch.column("grp").take(again),
                pa.array(np.tile(np.arange(codes.tables, dtype=np.int32), batch.num_rows)), pa.array(keys.ravel())],
                ["cid", "grp", "t", "key"])

    return run


def _links(shipped, cosine: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups come one after the other; the last of a batch waits for the next batch."""

    def run(batches):
        codes, dims = kept(shipped, codes_of), shipped.value["dims"]
        held: pa.Table | None = None

        def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = {c: rows.column(c).to_numpy() for c in ("bucket", "first", "second", "own", "t", "cid", "times")}
            named = np.stack([columns[c] for c in ("bucket", "first", "second")], axis=1)
            starts = np.flatnonzero(np.append(True, (named[1:] != named[:-1]).any(axis=1)))
            vectors = rows.column("vector").combine_chunks()
            x = unit(matrix(vectors, dims))
            found = compare_groups(columns["cid"], columns["times"], columns["own"], x, codes.keys(x), columns["t"][starts], starts,
                                   columns["first"][starts], columns["second"][starts], cosine)
            if found:
                cid, links, other = np.concatenate(found).T
                yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(links), pa.array(other)], ["cid", "links", "other"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]) if held is not None else rows
            last = held.slice(held.num_rows - 1, 1).to_pydict()
            same = np.ones(held.num_rows, dtype=bool)
            for c in ("bucket", "first", "second"):
                same &= held.column(c).to_numpy() == last[c][0]
            at = held.num_rows - int(same.sum())
            if at:
                yield from work(held.slice(0, at))
                held = held.slice(at)
        if held is not None and held.num_rows:
            yield from work(held)

    return run


def link_classes(classes: DataFrame, cosine: float = LEAST_COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame | None:
    """``cid, links, other`` for linked classes (cid, grp, vector, times): counts add up over the rows of a class, and the other
    is of its component. None if there are no two classes of a group.

    ``grp`` names the vectors that may link. The rotations are learned on about ``sample`` classes and all are indexed."""
    spark = classes.sparkSession
    total, dims = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    if largest < 2:
        return None
    width, tables = plan_tables(largest, cosine)
    share = min(1.0, sample / total)
    picked = classes.where(F.pmod(F.xxhash64("vector", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("vector")
    rows = [matrix(b.column(0), dims) for b in picked.toArrow().to_batches() if b.num_rows]
    codes = learn_codes(np.concatenate(rows) if rows else np.eye(dims), width, tables)
    shipped = ship(spark, mean=codes.mean, planes=codes.planes, width=width, dims=dims)

    group_type = classes.schema["grp"].dataType.simpleString()
    keys = cut(classes.select("cid", "grp", "vector").mapInArrow(_keys(shipped), f"cid long, grp {group_type}, t int, key long"))
    crowded = keys.groupBy("grp", "t", "key").agg(F.count("*").alias("n")).where("n > 1")
    crowded = cut(crowded.withColumn("bucket", F.monotonically_increasing_id()))
    salted = crowded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = keys.withColumn("salt", F.pmod(F.hash("cid"), F.lit(SALTS))).join(salted, ["grp", "t", "key", "salt"])
    blocks = F.ceil(F.col("n") / block)
    met = met.select("cid", "bucket", "t", F.pmod(F.xxhash64("cid", "bucket"), blocks).alias("own"), blocks.alias("blocks"))
    met = met.join(classes.select("cid", "vector", "times"), "cid")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = met.withColumn("partner", other).select(
        "bucket", F.least("own", "partner").alias("first"), F.greatest("own", "partner").alias("second"), "own", "t", "cid", "times", "vector")
    group = ["bucket", "first", "second"]
    return cut(met.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links(shipped, cosine), LINKS))


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = LEAST_COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector.

    Vectors of one label link at a cosine of ``cosine`` or more. A null label, and a vector that is null, empty, zero, or holds
    null or non-finite entries, link with nothing; vectors of different lengths neither. Repeated rows link with each other, ids
    that come again stand for rows of their own. A component's id is its least id (null if all are null), and a row with a null
    id is never kept. An empty table gives an empty result; other columns are not looked at.
    """
    numbers = F.col(vector).cast("array<double>")
    whole = usable(F.col(vector)) & F.exists(F.col(vector), lambda c: c != 0) & F.col(label).isNotNull()
    # 128 bits beside label and length tell vectors apart.
    rows = vectors.select(
        F.col(id).alias("vec_id"), F.col(label).alias("label"), F.when(whole, numbers).alias("vector")
    ).select("vec_id", "label", "vector", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("h1"),
             F.xxhash64(F.lit("second"), "vector").alias("h2"), F.coalesce(F.size("vector"), F.lit(0)).alias("dims"))
    same = ["label", "dims", "h1", "h2"]
    classes = rows.where("h1 IS NOT NULL").groupBy(*same).agg(
        F.first("vector").alias("vector"), F.count("*").alias("times"), F.min("vec_id").alias("low"))
    classes = cut(classes.withColumns({"cid": F.monotonically_increasing_id(), "grp": F.struct("label", "dims")}))
    links = link_classes(classes.select("cid", "grp", "vector", "times"), cosine, sample, block)

    own = classes.select("cid", *same, "low", (F.col("times") - 1).alias("copies"))
    if links is None:
        found = own.select(*same, F.col("copies").alias("n_links"), F.col("low").alias("least"))
    else:
        joined = components(links.select(F.col("cid").alias("u"), F.col("other").alias("v")))
        counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
        sized = own.join(counts, "cid", "left").join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        sized = cut(sized.withColumn("root", F.coalesce("root", "cid")))
        lowest = sized.where("links IS NOT NULL").groupBy("root").agg(F.min("low").alias("lowest"))
        sized = lookup(sized, lowest, {"root": "root"}, {"lowest": "lowest"})
        found = sized.select(*same, (F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"),
                             F.coalesce("lowest", "low").alias("least"))
    out = lookup(rows.drop("vector"), cut(found), {c: c for c in same}, {"n_links": "n_links", "least": "least"})
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


by_value(__name__)
