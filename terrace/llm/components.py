"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import passing, stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node to the smallest of them (or the node itself).

    Large: neighbours greater than the node; small: the node and those smaller.
    """
    if large:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    linked = both.join(least, "a")
    if large:
        found = linked.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        found = linked.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(least.select("a", F.col("_m").alias("b")))
    return found.where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the pairs (a, b) but the roots: root is the smallest node that it reaches.

    Every round halves the paths at least; the driver sees a count and a checksum a round. Loops and
    repeated pairs are harmless, and no pairs give no rows.
    """
    with passing(pairs.sparkSession) as keep:
        pairs = stored(pairs.where("a <> b").distinct(), "pairs")
        seen = None
        while True:
            now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
            if now == seen or not now["n"]:
                return keep(pairs).select(F.col("a").alias("node"), F.col("b").alias("root"))
            seen = now
            pairs = stored(_star(_star(pairs, large=True), large=False), "pairs")
