"""Connected components of an edge table, as Spark jobs (large-star / small-star).

Each round joins the edges with the smallest neighbour of each vertex (a partially
aggregated minimum, never a list), so a vertex with a third of all edges is a skewed join
that adaptive execution splits, not a group in one task. Rounds are written to the
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import stage


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, root) of every vertex of ``edges`` (a, b): root is the smallest vertex it reaches.

    Loops, repeated and reversed edges are allowed; rows with a null end are left out. An
    empty table gives an empty result. Raises if ``max_rounds`` do not settle it (rounds
    grow with the logarithm of the longest path).
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stage(e, "edges")
    was = _fingerprint(e)
    for _ in range(max_rounds):
        if not was[0]:
            break
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # both ends lie below a, yet either may be the smaller
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        e = stage(small.unionAll(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        now = _fingerprint(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    return e.select(F.col("a").alias("v"), F.col("b").alias("root")) \
        .unionAll(e.select(F.col("b").alias("v"), F.col("b").alias("root"))).distinct()
