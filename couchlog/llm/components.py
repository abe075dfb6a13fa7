"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couchlog.llm.common import drop_staged, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of `edges` (a, b); the component is its smallest vertex.

    Alternates two steps until nothing changes: every vertex hands its larger neighbours (large star),
    then its smaller ones (small star), to the smallest vertex it knows. The number of rounds grows
    with the logarithm of the longest path. State per vertex is one minimum, so a vertex with very
    many neighbours costs rows in a join that can be split, and no list.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, state = None, _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(after)
        drop_staged(now)
        now = after
    return now.toDF("id", "component").unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
