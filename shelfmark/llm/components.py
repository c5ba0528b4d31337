"""Connected components of an edge table, by alternating star contractions.

Every round is two joins and two aggregations on vertex ids; a vertex with many edges is only ever
a minimum per group, never a list. Rounds end when the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.storage import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of ``edges`` (a, b: long); root is the least vertex."""
    now = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        oriented = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = oriented.groupBy("a").agg(F.min("b").alias("m"))
        joined = oriented.join(lowest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = stored(small, "edges")
        new = _fingerprint(now)
        if new == state:
            break
        state = new
    # Stars remain: every vertex but the root has one edge, to the root.
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
