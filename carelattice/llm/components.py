"""Connected components of a link table by alternating star contractions.

Every round replaces links by links to smaller neighbours (large star, then
small star) with one grouped minimum and one join each. A round is a written
table in the shared work folder. Links only ever shrink towards the smallest
node of a component, so the number of rounds grows with the logarithm of the
longest chain. Only a count and a checksum of each round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import written

# Parts over which the links of one node are spread in a join.
SPREAD = 16


def join_spread(many: DataFrame, few: DataFrame, key: str, by: str) -> DataFrame:
    """``many`` joined to ``few``, which has one row per ``key``.

    Rows of a key are dealt to ``SPREAD`` tasks by column ``by``, and the one row is
    repeated for each: the smallest member of a large class holds most of its links.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part")
    dealt = many.withColumn("part", F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int"))
    return dealt.join(few.select("*", parts), [key, "part"]).drop("part")


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Per node ``a`` the smaller of itself and its smallest neighbour ``b``."""
    return links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        join_spread(both, _least_neighbour(both), "a", "b")
        .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = _least_neighbour(links)
    moved = (
        join_spread(links, least, "a", "b").where(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of a link table (a, b); root is the smallest node.

    Self links and NULL ends are ignored, repeated links allowed, an empty table
    gives an empty result. Nodes without links are not listed.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = written(
        links.where("a is not null and b is not null and a <> b").select(a, b).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        now = written(_small_star(_large_star(now)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
