"""Connected components of a distributed edge list, by alternating large and small stars.

Each round makes every node point to a smaller one of its neighbourhood, until all point to the smallest of
their component.  Rows stay linear in the edges, nothing is collected, and every round is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.lineage import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``u, v`` rows of long ids.

    Loops and repeated edges are allowed; a row with a null end links nothing; no edges give no rows.
    """
    named = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now = cut_lineage(named.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(smallest.select("u", F.col("m").alias("v"))).distinct())
        now = cut_lineage(small, "stars")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
