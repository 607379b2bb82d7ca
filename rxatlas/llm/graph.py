"""Connected components of an edge table as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id of ``edges`` (columns a, b: long):
    component is the smallest id that links reach.

    Alternating star contraction: every id is linked to the smallest of its
    neighbours until only stars are left, in a number of rounds that grows with
    the logarithm of the longest path. Only sums per id and equi-joins: a hub
    is pre-aggregated, and AQE splits its join. Each round is written to the
    shared folder. Self-links, repeated and reversed links are allowed; an
    empty table gives an empty table.
    """
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
               .where("a < b").distinct(), f"{name}-0")
    for i in range(MAX_ROUNDS):
        loose = e.join(e.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        if not loose and not e.groupBy("b").count().where("count > 1").limit(1).count():
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")
        large = stored(large.distinct(), f"{name}-large-{i}")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        e = stored(small.union(least.select(F.col("m").alias("a"), "b")).distinct(), f"{name}-{i + 1}")
    else:
        raise RuntimeError(f"components: not done after {MAX_ROUNDS} rounds")
    return e.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        e.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
