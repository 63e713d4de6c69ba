"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut


def _stars(links: DataFrame) -> DataFrame:
    """Both steps at once. Large star: every node links its larger neighbours to its least neighbour. Small star: every
    node links its smaller neighbours, and itself, to the least of them. Keeps components; links only move towards roots."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = cut(large.where(F.col("u") != F.col("v")).distinct())
    # Now u > v in every row.
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (u, v): the least node of its component. Nodes without a link are left out.

    The rounds end when no link changes; their number grows with the logarithm of the longest chain, and each round
    shuffles links only.
    """
    links = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = None
    while True:
        links = _stars(links)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v"), F.col("v")).distinct())
