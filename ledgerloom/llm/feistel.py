"""A keyed permutation of 0 .. n-1 as a Column expression.

A generalised Feistel network permutes the cells of the smallest near-square grid ``a * b`` that holds n numbers: the two
coordinates take turns in being shifted by a hash of the other one. A number that lands outside n goes through the
network again (cycle walking) until it lands inside.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
# Fewer than ``a`` cells lie outside n, about one of every ``a`` at most. Up to 24 rows of the grid a walk is over within
# this many steps for certain; beyond, a longer one has a chance below 24 ** -24 and raises an error.
WALKS = 24


def hash60(key: Column, turn: Column, x: Column) -> Column:
    """60 bits of the MD5 of key, round and number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key, turn, x)), 1, 15), 16, 10).cast("long")


def permute(x: Column, n: Column, key: Column) -> Column:
    """Where the number x (0 <= x < n) goes under the permutation that ``key`` names."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    b = F.greatest(F.ceil(n / a).cast("long"), F.lit(1).cast("long"))
    grid = F.struct(a.alias("a"), b.alias("b"))

    def network(y: Column, g: Column) -> Column:
        def turn(s: Column, t: Column) -> Column:
            left = (s["l"] + hash60(key, t, s["r"])) % g["a"]
            right = (s["r"] + hash60(key, t, s["l"])) % g["b"]
            return F.when(t % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
                F.struct(s["l"].alias("l"), right.alias("r"))
            )

        start = F.struct((y % g["a"]).alias("l"), F.floor(y / g["a"]).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] + s["r"] * g["a"])

    def walk(y: Column, g: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(WALKS))
        last = F.aggregate(steps, network(y, g), lambda z, _: F.when(z < n, z).otherwise(network(z, g)))
        return last

    # A one-element array binds the grid to a name, so that it is worked out once.
    place = F.transform(F.array(grid), lambda g: walk(x.cast("long"), g))[0]
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("a cycle walk did not end; choose another key")).cast("long"))
