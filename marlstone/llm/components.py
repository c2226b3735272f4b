"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import staged

MOST_ROUNDS = 50


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns node, root (the smallest node reachable) of every node of ``edges`` (a, b: long) that has a neighbour.

    Alternating large and small stars: each round hangs neighbours on the
    smallest node they know of, until only stars are left, after a number of
    rounds logarithmic in the graph's diameter. A round holds as many edges as
    the one before or fewer, and every minimum is aggregated before the shuffle,
    so a node with very many neighbours costs no more than those.
    """
    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = staged(edges.where("a <> b").select(*down).distinct(), "edges")
    before = _fingerprint(stars)
    for _ in range(MOST_ROUNDS):
        if before[0] == 0:
            break
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = staged(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).select(*down).distinct()
        )
        stars = staged(small, "edges")
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return staged(stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components").select("node", "root")
